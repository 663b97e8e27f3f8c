import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabscope.llm import qualityrules as qr
from tabscope.llm.common import WORD


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(inside), failed


def compare(frame):
    texts = sorted(((r.doc_id, *plain(r.text)) for r in frame.collect()), key=repr)
    made = qr.judged(frame).collect()
    assert sorted((tuple(r)[:-1] for r in made), key=repr) == texts
    assert not any(r.kept and r.base_failed for r in made)
    return made


def test_documents(documents, labels):
    made = {r.doc_id: r for r in compare(documents)}
    good = [r.doc_id for r in labels.where("quality = 1").collect()]
    assert all(made[d].kept or made[d].base_failed for d in good if d in made)


def test_awkward_rows(awkward, nothing):
    compare(awkward)
    assert qr.judged(nothing).count() == 0


@pytest.mark.parametrize("n", [4095, 4096, 9000])
def test_repeats_in_long_texts(n):
    words = [b"w%d" % (i % (n - 7)) for i in range(n)]
    assert qr.repeated_words(words) == plain(b" ".join(words).decode())[4]


def test_sketches_merge_and_bound_their_error(spark):
    rows = spark.range(20_000).selectExpr(
        "id AS doc_id", "'en' AS lang", "concat('s', id % 3) AS source", "100L AS n_words",
        "id AS n_symbols", "0L AS n_dup_lines", "1L AS n_lines", "500L AS word_chars",
    )
    sketch = qr.sketches(rows)
    total = qr.fences(qr.merged(sketch)).where("rate = 'symbols_a_word'").first()
    assert total.documents == 20_000
    # Uniform from 0 to 200: nine tenths, and three times the distance from the median.
    assert total.high == pytest.approx(180 + 3 * 80, rel=0.05) and total.low is None


def test_thresholds_adapt_to_their_group(spark):
    """A dollar a word is odd in one source and usual in another."""
    usual = " ".join(["price", "$", "seven"] * 10)
    odd = " ".join(f"word{i} $" for i in range(20))
    clean = " ".join(f"word{i}" for i in range(20))
    rows = [(i, usual.replace("seven", f"n{i}") + f" {odd}", "en", "shop") for i in range(300)]
    rows += [(1000 + i, f"{clean} x{i}", "en", "news") for i in range(300)] + [(5000, odd, "en", "news")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in qr.judged(frame).where("not base_failed").collect()}
    assert not kept[5000]
    assert all(kept[1000 + i] for i in range(300))
    assert all(kept.get(i, True) for i in range(300))


def plain_quantile(values, share):
    """Of the 2 % buckets the smallest that reaches the share."""
    placed = sorted(0 if v <= 1e-4 else math.ceil(math.log(v / 1e-4) / math.log(1.02)) for v in values)
    bucket = placed[max(0, math.ceil(share * len(placed) - 1e-9) - 1)]
    return 0.0 if bucket == 0 else 1e-4 * 1.02**bucket


def plain_fences(values, rule):
    n = len(values)
    lower, middle, upper = (plain_quantile(values, q) for q in (1 - rule.quantile, 0.5, rule.quantile))
    room = rule.tolerance * math.sqrt(200 / (n + 200))
    high = max(upper + 3 * (upper - middle), middle + room)
    return n, high, min(lower - 3 * (middle - lower), middle - room) if rule.both_sides else None


def drawn(own, wider):
    n, *sides = own
    w = n / (n + 200)
    return n, *[None if a is None else w * a + (1 - w) * b for a, b in zip(sides, wider[1:], strict=True)]


def plain_verdicts(rows):
    """kept of every (lang, source, text), one group at a time."""
    counts = [plain(t) for _, _, t in rows]
    lines = [sum(bool(re.search(WORD, x)) for x in (t or "").split("\n")) for _, _, t in rows]
    rates = [
        {
            "symbols_a_word": c[2] / c[0] if c[0] else 0.0,
            "repeated_lines": c[3] / n if n else 0.0,
            "letters_a_word": c[1] / c[0] if c[0] else 0.0,
        }
        for c, n in zip(counts, lines, strict=True)
    ]
    groups = {}
    for (lang, source, _), r, c in zip(rows, rates, counts, strict=True):
        if c[0]:
            for key in ((), (lang,), (lang, source)):
                groups.setdefault(key, []).append(r)
    out = []
    for (lang, source, _), r, c in zip(rows, rates, counts, strict=True):
        odd = c[5]
        for name, rule in qr.RATES.items():
            if c[0]:
                of = lambda *key: plain_fences([x[name] for x in groups[key]], rule)  # noqa: B023, E731
                _, high, low = drawn(of(lang, source), drawn(of(lang), of()))
                odd |= r[name] > high or (low is not None and r[name] < low)
        out.append(not odd)
    return out


def test_verdicts_against_a_plain_version(spark, documents, awkward):
    for frame in (documents, awkward):
        rows = [(r.lang, r.source, r.text) for r in frame.collect()]
        due = sorted(zip([r.doc_id for r in frame.collect()], plain_verdicts(rows), strict=True), key=repr)
        made = sorted(((r.doc_id, r.kept) for r in qr.judged(frame).collect()), key=repr)
        assert made == due


def test_every_group_has_fences_of_its_own(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    made = qr.thresholds(qr.measured(documents)).collect()
    assert len(made) == 80
    for rate, rule in qr.RATES.items():
        assert len({getattr(r, f"_high_{rate}") for r in made}) > 40
        assert (len({getattr(r, f"_low_{rate}") for r in made}) > 40) == rule.both_sides


def test_a_few_symbols_are_odd_where_nobody_else_has_any(spark):
    clean = " ".join(f"word{i}" for i in range(50))
    rows = [(i, f"{clean} x{i}", "en", "news") for i in range(200)]
    rows.append((5000, " ".join(f"word{i}" + (" $" if i % 6 == 0 else "") for i in range(43)), "en", "news"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    made = {r.doc_id: r for r in qr.judged(frame).collect()}
    assert 0.13 < made[5000].n_symbols / made[5000].n_words < 0.16
    assert not made[5000].kept and not made[5000].base_failed
    assert all(made[i].kept for i in range(200))


def test_most_good_documents_stay(spark):
    root = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", "quality").distinct()
    made = qr.judged(spark.read.parquet(f"{root}/documents.parquet")).join(labels, "doc_id")
    shares = {r.quality: r.k / r.n for r in made.groupBy("quality").agg(F.count_if("kept").alias("k"), F.count("*").alias("n")).collect()}
    assert shares[1] > 0.97 and shares[0] < 0.1
