"""op4: planted passages with substitutions, and edge cases; the SQL check covers the given tables."""

import itertools
import math
import random

from glossa.llm import decontaminate


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(n)]


def test_planted(table, spark):
    rng = random.Random(4)
    items = {i: words(rng, n) for i, n in enumerate([15, 20, 40, 59, 10])}
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(50, "so few"), (51, None), (52, "")], "item_id long, text string")
    rows, expected = [], {}
    for d in range(40):
        item = d % 5
        body, passage = words(rng, rng.randint(0, 300)), list(items[item])
        if d % 4 == 0:  # one word in ten replaced, punctuation and case changed
            for k in range(5, len(passage), 10):
                passage[k] = "other"
            passage = [w.upper() + "," if k % 3 else w + "***" for k, w in enumerate(passage)]
        at = rng.randint(0, len(body))
        if d % 3:
            rows.append((d, " ".join(body[:at] + passage + body[at:])))
            expected[d] = True
        else:
            rows.append((d, " ".join(body)))
            expected[d] = False
    rows += [(100, None), (101, ""), (102, "too short"), (103, " ".join(items[2][:9])), (None, " ".join(items[1])), (104, "the " * 50_000 + " ".join(items[0])), (1, rows[1][1])]
    expected |= {100: False, 101: False, 102: False, 103: False, None: True, 104: True}
    docs = table(rows)
    out = decontaminate.decontaminate(docs, bench).collect()
    assert len(out) == len(rows)
    wrong = [r for r in out if r["contaminated"] != expected[r["doc_id"]]]
    assert not wrong
    assert {r["first_item"] for r in out if r["doc_id"] == 1} == {1}
    clean = decontaminate.clean_only(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in out if not r["contaminated"]}


def test_clean_text_stays(table, spark):
    rng = random.Random(9)
    vocabulary = words(rng, 60)  # a small vocabulary: chance hits need to fail the verification
    bench = spark.createDataFrame([(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(20)], "item_id long, text string")
    docs = table([(i, " ".join(rng.choices(vocabulary, k=400))) for i in range(30)])
    assert decontaminate.decontaminate(docs, bench).where("contaminated").count() == 0


def test_empty_tables(table, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(table([(1, "some text")]), none).first()["contaminated"] is False
    assert decontaminate.decontaminate(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0


def found_share(n, changes):
    """The share of all ways to change so many of n tokens that leave some seed of the item whole."""
    places = [{at + k for k, bit in enumerate(mask) if bit == "1"} for mask, fewest, most in decontaminate.ALL_MASKS if fewest <= n <= most for at in range(n - len(mask) + 1)]
    ways = [set(c) for c in itertools.combinations(range(n), changes)]
    return sum(any(not p & w for p in places) for w in ways) / len(ways)


def test_recall_by_length():
    for n in range(7, 24):
        for changes in range(n - math.ceil(decontaminate.LEAST * min(n, decontaminate.WINDOW)) + 1 if n <= decontaminate.WINDOW else 4):
            assert found_share(n, changes) > (0.95 if n < 16 else 0.92), (n, changes)
    assert all(found_share(n, 0) == 1 for n in range(decontaminate.SHORTEST, 30))


def test_short_items_and_items_without_an_id(table, spark):
    rng = random.Random(3)
    items = {i: words(rng, n) for i, n in enumerate([3, 4, 6, 7, 9, 10, 11, 12, 15])}
    rows = [(None if i == 5 else i, " ".join(w)) for i, w in items.items()] + [(None, "another one without any id"), (None, "of two")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs, expected = [], {}
    for i, w in items.items():
        body = words(rng, 50)
        docs.append((i, " ".join(body[:20] + w + body[20:])))
        expected[i] = (True, 1, None if i == 5 else i)
        changed = list(w)
        for k in rng.sample(range(len(w)), 1 if len(w) < 10 else 2):
            changed[k] = "changed"
        docs.append((100 + i, " ".join(body[:20] + changed + body[20:])))
        if len(w) >= 7:
            allowed = len(w) - math.ceil(decontaminate.LEAST * len(w)) >= (1 if len(w) < 10 else 2)
            expected[100 + i] = (allowed, int(allowed), None if i == 5 or not allowed else i)
        else:
            expected[100 + i] = (False, 0, None)
    docs += [(200, "x Another one, without any ID y " + " ".join(items[5])), (201, "of two")]
    expected |= {200: (True, 1, None), 201: (False, 0, None)}
    got = {r["doc_id"]: (r["contaminated"], r["n_items"], r["first_item"]) for r in decontaminate.decontaminate(table(docs), bench).collect()}
    assert got == expected


def test_clashing_columns(table, spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    docs = table([(1, "one two three four five six seven eight"), (2, "clean"), (None, None)])
    for name in ("_id", "_text", "_TEXT_", "seed", "at", "item_id", "_item"):
        docs = docs.withColumn(name, docs["word"])
    kept = decontaminate.clean_only(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, None}
