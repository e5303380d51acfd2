import re
from collections import Counter

from tessera.llm import quality


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_counts_of_odd_rows(odd):
    got = sorted(map(str, (tuple(r)[1:] if r[0] is None else tuple(r) for r in quality.measure(odd.select("doc_id", "text")).collect())))
    assert got == sorted(str(((r.doc_id,) if r.doc_id is not None else ()) + counts(r.text)) for r in odd.collect())


def test_sketch_bin_keeps_the_leading_bits(spark):
    values = [0, 1, 127, 128, 129, 255, 256, 1000, 123456789]
    from pyspark.sql import functions as F
    got = [r[1] for r in spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.sketch_bin(F.col("v"))).collect()]
    want = [(v >> max(0, len(bin(v)) - 2 - 7)) << max(0, len(bin(v)) - 2 - 7) for v in values]
    assert got == want


def test_fences_move_with_the_group(spark):
    # group a is prose without symbols, group b has three symbols a word throughout
    rows = [(i, "a", "s", " ".join(f"word{i * 50 + j}" for j in range(50))) for i in range(250)]
    rows += [(1000 + i, "b", "s", " ".join(f"#$%w{i * 50 + j}" for j in range(50))) for i in range(250)]
    rows += [(5000, "a", "s", " ".join(f"#$%w{j}" for j in range(50)))]
    judged = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")).collect()}
    assert not judged.pop(5000) and all(judged.values())


def test_empty_and_odd_tables(odd, none):
    assert quality.judge(none).collect() == []
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count() and not any(r.kept for r in rows if r.base_failed)
