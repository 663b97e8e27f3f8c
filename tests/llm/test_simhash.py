import re

import numpy as np
import pytest
import xxhash

from tabscope.llm import simhash
from tabscope.llm.common import WORD
from tabscope.llm.components import components


def plain(rows, bits=simhash.MAX_BITS):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    prints = []
    for _, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(WORD, lowered)
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles if words]
        ones = [sum(h >> b & 1 for h in hashes) for b in range(64)]
        prints.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(hashes)))
    every = np.array(prints, np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(every ^ every[i]) <= bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[find(i)] = min(doc_id, first.get(find(i), doc_id))
    return sorted(
        ((d, f"{p:016x}", first.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))),
        key=repr,
    )


@pytest.mark.parametrize("code", [None, *simhash.CODES], ids=lambda c: c.name if c else "cheapest")
def test_every_code_gives_the_links_of_all_pairs(documents, rows, code):
    want = plain([tuple(r) for r in documents.select("doc_id", "text").collect()])
    assert rows(simhash.near_duplicates(documents, code=code)) == want


def test_awkward_rows(awkward, rows):
    want = plain([tuple(r) for r in awkward.select("doc_id", "text").collect()])
    assert rows(simhash.near_duplicates(awkward)) == want


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(nothing).count() == 0


def test_one_row_of_each_component_stays(awkward):
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    pairs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    left = [r.doc_id for r in kept.collect()]
    groups = {c for _, _, c in plain(pairs)}
    assert sorted(left, key=repr) == sorted(groups, key=repr)


@pytest.mark.parametrize("code", simhash.CODES, ids=lambda c: c.name)
def test_planted_links_at_every_distance(spark, code):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base.copy()
    for i in range(len(base)):
        for bit in rng.choice(64, i % 5, replace=False):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    both = sorted(set(np.concatenate([base, near]).view(np.int64).tolist()))
    frame = spark.createDataFrame([(x,) for x in both], "fp long")
    found = {tuple(sorted(map(int, r))) for r in simhash.links(frame, len(both), 4, code).collect()}
    due = {
        tuple(sorted((int(a), int(b))))
        for a, b in zip(base.view(np.int64), near.view(np.int64), strict=True)
        if a != b
    }
    assert due <= found


def test_crowded_cells_are_dealt_out_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_HOMES", 8)
    chain = [sum(1 << b for b in range(i)) for i in range(1, 60)]  # neighbours differ in a bit
    dense = [(1 << 62) | (1 << a) | (1 << b) for a in range(40) for b in range(a)]
    frame = spark.createDataFrame([(x,) for x in chain + dense], "fp long")
    found = simhash.links(frame, len(chain + dense), 4, simhash.CODES[0])
    roots = dict(tuple(r) for r in components(found).collect())
    assert len({roots[x] for x in chain}) == 1
    assert len({roots[x] for x in dense}) == 1


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, x) for x in range(1001, 1200)] + [(7, 7)]
    frame = spark.createDataFrame(links, "u long, v long")
    roots = dict(tuple(r) for r in components(frame).collect())
    assert {roots[i] for i in range(201)} == {0}
    assert {roots[i] for i in range(1000, 1200)} == {1000}
    assert components(frame.where("false")).count() == 0
