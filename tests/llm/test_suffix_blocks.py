"""Suffix deduplication where one block holds very many rows of few kinds, and rows repeat wholly."""

import random

import pytest

from pisteflow.llm import suffixes
from tests.llm.test_operators import _removed, key, table, words


@pytest.mark.parametrize("classes", [2048, 4])
def test_many_rows_of_few_kinds(spark, monkeypatch, classes):
    """A common passage, each time after other words, goes on in one of a few ways."""
    monkeypatch.setattr(suffixes, "GROUP_CLASSES", classes)
    taken, sort = [], suffixes._resolve

    def watched(pieces, length, blocks):
        # Beyond the first level a key has no more rows than kinds.
        if len(blocks) < len(suffixes.BLOCKS):
            taken.append(pieces.groupBy("key").count().join(pieces.select("key", "classes").distinct(), "key").where("count > classes").count())
        return sort(pieces, length, blocks)

    monkeypatch.setattr(suffixes, "_resolve", watched)
    rnd = random.Random(21)
    passage, ends = words(rnd, 30), [words(rnd, 2) for _ in range(3)]
    rows = [(i, words(rnd, 12) + passage + ends[i % 3] + words(rnd, 3), "en", "a") for i in range(60)]
    rows += [(None, rows[0][1], None, None)] * 25 + [rows[1]] * 10
    got = suffixes.remove_repeats(table(spark, rows).repartition(4), length=80)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=key) == _removed(rows, 80)
    assert not any(taken) and (classes > 4 or taken)
