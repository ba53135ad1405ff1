"""op6: exact round trip, budgets, masks and history."""

import hashlib
import random

from glossa.llm import chat_format

BAD = ["\\", "\\\\", "\\b", "\\l<#", "### user\nhi</turn>\n", "</turn>", "<", "#", "\\### Assistant: </turn> ok", "", None, "a\nb", "ä😀 " * 3]


def conversations(spark, seed, n=40):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 30)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "tool", None, "we<i\nrd"])
            text = rng.choice(BAD) if rng.random() < 0.3 else " ".join("w" * rng.randint(1, 6) for _ in range(rng.choice([1, 5, 50, 200])))
            rows.append((c if c else None, t, role, text))
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)


def test_round_trip(spark):
    rows, df = conversations(spark, 1)
    out = {r["conv_id"]: r for r in chat_format.chat_digest(df, budget=200, history=40).collect()}
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: r[1]):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = out[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_windows_keep_budget_and_system(spark):
    rows, df = conversations(spark, 2)
    system = {c: len((text or "").split()) + chat_format.OVERHEAD for c, t, role, text in rows if t == 0 and role == "system"}
    windows = chat_format.format_chat(df, budget=200, history=40).collect()
    assert any(w["n_repeated"] > 1 for w in windows)
    for w in windows:
        new = w["n_turns"] - w["n_repeated"]
        assert new == 1 or w["n_tokens"] <= max(200, system.get(w["conv_id"], 0) + 40 + chat_format.LEAST_ROOM)
        assert w["formatted"].count("</turn>\n") == w["n_turns"]
        if w["conv_id"] is not None and w["conv_id"] % 3 == 0:
            assert w["formatted"].startswith("### system\n")
        for s in w["loss_spans"]:
            assert w["formatted"][: s["start"]].endswith("### assistant\n") and w["formatted"][s["stop"] :].startswith("</turn>\n")


def test_probe_ties_and_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    (r,) = chat_format.chat_digest(chat_format.with_probe(spark, empty)).collect()
    assert r["conv_id"] == -7 and r["n_turns"] == 2
    assert r["loss_sha256"] == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest()
    tied = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "user", "c"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    (r,) = chat_format.chat_digest(tied).collect()
    assert r["turns_sha256"] == hashlib.sha256(b"user\nc\nuser\na\nuser\na\nuser\nb\n").hexdigest()
    assert chat_format.chat_digest(empty).count() == 0
