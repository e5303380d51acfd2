import hashlib
import random

import xxhash

from tessera.llm import winnow

K, W = winnow.K, winnow.W


def tokens(text):
    """Words; of runs of over 16 characters every character."""
    return [t for w in (text or "").encode().split() for t in ([c.encode() for c in w.decode()] if len(w.decode()) > 16 else [w])]


def kept(text):
    words = [xxhash.xxh64_intdigest(w, seed=42) for w in tokens(text)]
    grams = []
    for i in range(max(len(words) - K + 1, min(1, len(words)))):
        seed = 42
        for x in words[i:i + K]:
            seed = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed=seed)
        grams.append((seed - (1 << 64) if seed >> 63 else seed) >> 24)
    out = []
    for s in range(max(len(grams) - W + 1, min(1, len(grams)))):
        at = min(range(s, min(s + W, len(grams))), key=lambda i: (grams[i], -i))
        if at not in out[-1:]:
            out.append(at)
    return [(grams[i], i) for i in out]


def likeness(a, b):
    a, b = ({h for h, _ in x} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_equals_brute_force_on_odd_rows(odd, monkeypatch):
    monkeypatch.setattr(winnow, "ROWS_PER_BLOCK", 4)
    monkeypatch.setattr(winnow, "FAN", 2)
    docs = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode()))
    want = []
    for i, (key, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        made = text[:len(text) - half] + after[:half]
        a, b, c = kept(text), kept(made), kept(after)
        show = lambda x: [((h & ((1 << 40) - 1)), p) for h, p in x]
        want.append((str(key), len(text), hashlib.sha256(made.encode()).hexdigest(), show(a), show(b), likeness(a, b), likeness(a, c)))
    unpack = lambda x: [((v >> 24) & ((1 << 40) - 1), winnow.POSITIONS - 1 - (v & (winnow.POSITIONS - 1))) for v in x]
    got = [(str(r.key), r.n_chars, r.edited_sha256, unpack(r.kept), unpack(r.edited_kept), r.near_edited, r.near_next)
           for r in winnow.edited(odd).collect()]
    assert sorted(got) == sorted(want)


def test_shared_passages_share_a_gram(spark):
    passage = " ".join(f"p{i}" for i in range(K + W - 1))
    df = spark.createDataFrame([(" ".join(f"{t}{i}" for i in range(40)) + " " + passage + f" {t}z",) for t in "ab"], "text string")
    one, two = ({x >> 24 for x in r.kept} for r in winnow.fingerprints(df, "text", "kept").collect())
    assert one & two


def test_texts_without_blanks_have_fingerprints_along_them(spark):
    rng = random.Random(4)
    text = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(2_000))
    other = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(2_000)) + "𝄞" * 30
    rows = {r.key: r for r in winnow.edited(spark.createDataFrame([(1, text), (2, other)], "doc_id long, text string")).collect()}
    assert rows[1].near_edited > 0.3 and rows[1].near_next == 0 and len(rows[1].kept) > 300


def test_empty_table(none):
    assert winnow.edited(none).collect() == []
