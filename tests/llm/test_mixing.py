import math
import re

import pytest

from tabscope.llm import mixing
from tabscope.llm.common import WORD, content_order, identified


def shares(sizes, weights, budget, most):
    """Targets by sharing the excess again and again."""
    target = dict.fromkeys(sizes, 0.0)
    open_ = set(sizes)
    left = budget
    while open_:
        total = sum(weights[s] for s in open_)
        given = {s: left * weights[s] / total for s in open_}
        full = {s for s in open_ if given[s] >= most * sizes[s]}
        if not full:
            target.update(given)
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check(frame, made):
    rows = frame.select("doc_id", "text", "source").collect()
    words = [len(re.findall(WORD, r.text or "")) for r in rows]
    sizes = {}
    for r, n in zip(rows, words, strict=True):
        sizes[r.source] = sizes.get(r.source, 0) + n
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be"))
    order += [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = shares(sizes, weights, 1.5 * sum(words), 2)
    by_target = {}
    for r in made:
        assert r.taken <= 2 * r.size
        key = (r.source_size, round(r.target, 6))
        by_target[key] = by_target.get(key, 0) + r.taken
    assert sorted((n, round(want[s], 6)) for s, n in sizes.items()) == sorted(
        {(sizes[s], round(want[s], 6)) for s in sizes}
    ) or len(by_target) <= len(sizes)
    assert set(by_target) == {(sizes[s], round(want[s], 6)) for s in sizes}
    assert sorted((r.doc_id, r.size) for r in made if r.doc_id) == sorted(
        (r.doc_id, n) for r, n in zip(rows, words, strict=True) if r.doc_id
    )
    return by_target


def test_targets_and_taken_words(documents):
    made = mixing.mix(documents).collect()
    biggest = max(r.size for r in made)
    for (_, target), taken in check(documents, made).items():
        assert abs(taken - target) <= biggest / 2
    places = [r.position for r in made if r.position is not None]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places)


def test_reruns_agree(documents):
    assert mixing.mix(documents).collect() == mixing.mix(documents).collect()


def test_awkward_rows(awkward, nothing):
    check(awkward, mixing.mix(awkward).collect())
    kept = mixing.mixed(awkward)
    assert kept.columns == awkward.columns
    taken = sum(r.taken for r in mixing.mix(awkward).collect())
    assert sum(len(re.findall(WORD, r.text or "")) for r in kept.collect()) == taken
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_buckets_do_not_change_the_mix(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    made = mixing.mix(documents).collect()
    biggest = max(r.size for r in made)
    for (_, target), taken in check(documents, made).items():
        assert abs(taken - target) <= biggest / 2


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_schedules_are_inverted(spark, kind):
    values = mixing.SCHEDULES[kind]
    shares_ = spark.createDataFrame([(i / 200,) for i in range(201)], "share double")
    from pyspark.sql import functions as F

    time = mixing.schedule_time(F.col("share"), F.lit(kind), mixing.SCHEDULES).alias("t")
    pieces = len(values) - 1

    def spent(t):
        done = 0.0
        for i in range(pieces):
            a, b = values[i], values[i + 1]
            x = min(max(t * pieces - i, 0), 1)
            done += (a * x + (b - a) * x * x / 2) / pieces
        return done

    for share, t in shares_.select("share", time).collect():
        assert abs(spent(t) / spent(1.0) - share) < 1e-9


def test_no_python_on_the_main_path(documents):
    plan = mixing.mixed(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_documents_do_not_end_a_pass(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    rows = []
    for source in range(12):
        sizes = [10] * 100 + [1000] + [0] * 3
        rows += [(1000 * source + i, "w " * n, f"s{source:02}") for i, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, places = {}, {}
    for r in mixing.mix(frame, weights=(1,)).collect():
        taken[r.doc_id // 1000] = taken.get(r.doc_id // 1000, 0) + r.taken
        places.setdefault(r.doc_id // 1000, []).append(r.position)
        assert r.target == 3000
    assert set(taken.values()) == {3000}
    assert all(None not in p and max(p) <= 1 for p in places.values())


def copied(frame, path, files):
    """The same rows under another path, in other files and another order."""
    frame.repartition(files).write.parquet(str(path))
    return frame.sparkSession.read.parquet(str(path))


def test_the_mix_does_not_depend_on_where_the_rows_are(documents, awkward, tmp_path):
    for i, frame in enumerate((documents, awkward)):
        there = [copied(frame, tmp_path / f"{i}-{n}", n) for n in (1, 5)]
        one, two = (mixing.mix(f).collect() for f in there)
        assert one == two
        one, two = (mixing.mixed(f).collect() for f in there)
        assert one == two


def test_columns_named_like_the_stages_own_stay(documents):
    from pyspark.sql import functions as F

    frame = documents.limit(50).withColumn("_tabscope_row", F.col("doc_id") + 1).withColumn("_Tabscope_Position", F.lit("x"))
    made = mixing.mixed(frame)
    assert made.columns == frame.columns
    assert all(r._tabscope_row == r.doc_id + 1 for r in made.collect())


def words(text):
    return len(re.findall(WORD, text or ""))


def plain_mix(frame, bucket_rows):
    """Copies and positions of every row, source by source, in the stated order."""
    order, tie = content_order(frame, mixing.SEED, "doc_id", "text", "source")
    rows = frame.select("doc_id", "text", "source", order.alias("order"), tie.alias("tie")).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    kinds = {s: i % 3 for i, s in enumerate(names)}
    weights = {s: mixing.WEIGHTS[k] for s, k in kinds.items()}
    goal = shares(sizes, weights, 1.5 * sum(sizes.values()), 2)
    out = []
    for source in names:
        mine = [r for r in rows if r.source == source]
        buckets = max(1, math.ceil(len(mine) / bucket_rows))
        mine.sort(key=lambda r: (r.order % buckets, r.order, r.tie))
        total, target = sizes[source], goal[source]
        whole = int(target // total) if total else 0
        rest = target - whole * total
        within, ended, gap = {}, 0, rest
        left = [(i, words(r.text)) for i, r in enumerate(mine)] if rest > 0 else []
        left = [x for x in left if x[1] <= rest]
        while left:
            before, behind = 0, []
            for i, n in left:
                if before + n <= gap:
                    within[i] = ended + before
                else:
                    behind.append((i, n))
                before += n
            given = sum(n for i, n in left if i in within)
            gap, ended = gap - given, ended + given
            left = [x for x in behind if x[1] <= gap]
        others = [
            (abs(words(r.text) - gap), r.order, r.tie, i)
            for i, r in enumerate(mine)
            if rest > 0 and i not in within and words(r.text) and abs(words(r.text) - gap) < gap
        ]
        if others:
            within[min(others)[3]] = ended
        before = 0
        for i, r in enumerate(mine):
            n = words(r.text)
            copies = min(whole + (i in within), 2)
            places = []
            for c in range(copies):
                middle = c * total + (before if whole > c else within[i]) + n / 2
                places.append(plain_time(min(middle / target, 1.0), kinds[source]) if target else None)
            out.append((r.doc_id, n, n * copies, places))
            before += n
    return out


def plain_time(share, kind):
    """The time by halving, not in closed form."""
    values = mixing.SCHEDULES[kind]
    pieces = len(values) - 1

    def spent(t):
        done = 0.0
        for i in range(pieces):
            x = min(max(t * pieces - i, 0), 1)
            done += (values[i] * x + (values[i + 1] - values[i]) * x * x / 2) / pieces
        return done

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if spent(middle) < share * spent(1.0) else (low, middle)
    return high


@pytest.mark.parametrize("bucket_rows", [10_000, 7])
def test_rows_and_positions_against_a_plain_version(documents, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    due = sorted(plain_mix(documents, bucket_rows))
    made = sorted(
        (r.doc_id, r.size, r.taken, list(r.positions))
        for r in mixing.plan(identified(documents, mixing.ROW)).collect()
    )
    assert [m[:3] for m in made] == [d[:3] for d in due]
    for (*_, got), (*_, want) in zip(made, due, strict=True):
        assert got == pytest.approx(want, abs=1e-9)
