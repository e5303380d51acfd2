import hashlib
import random

import pytest

from tessera.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window int"


def test_turns_read_back_whatever_they_hold():
    rng = random.Random(5)
    parts = ["</s>", "<s>", "\\", "<", "\n", "a", "\\<", "\\n", "[INST]", "user\n", "é"]
    for _ in range(500):
        turns = [("".join(rng.choices(parts, k=rng.randint(0, 6))), "".join(rng.choices(parts, k=rng.randint(0, 9)))) for _ in range(3)]
        made = "".join(chat.written(*t)[0] for t in turns)
        assert [(r, t) for r, t, _, _ in chat.parsed(made)] == turns


@pytest.mark.parametrize("budget", [12, 60, 1024])
def test_digests(spark, budget):
    rng, rows = random.Random(budget), []
    for c in range(12):
        if c % 2:
            rows.append((c, 0, "system", "be kind </s>", 1))
        for t in range(1, rng.randint(2, 14)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice([None, "", "ok <s>", "word " * rng.randint(1, 30)]), 1))
    rows += [rows[0], rows[-1], (None, 0, "assistant", "no conversation", 1), (7, None, "assistant", "no turn", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    windows = chat.format_conversations(df, budget=budget)
    got = sorted(map(str, ((r.conv, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect())))
    want = []
    for key in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == key))
        text = "".join(f"{a}\n{b}\n" for _, _, a, b in turns)
        loss = "".join(b for _, _, a, b in turns if a == "assistant")
        want.append(str((key, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())))
    assert got == sorted(want)
    for w in windows.collect():
        turns = chat.parsed(w.formatted)
        assert len(turns) > w.repeated
        assert w.tokens <= budget or len(turns) - w.repeated == 1  # only a single long turn exceeds the budget
        assert all(turns[0][0] == "system" for _ in [0] if w.repeated and w.conv not in (None, 7) and w.conv % 2 and w.window)


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
