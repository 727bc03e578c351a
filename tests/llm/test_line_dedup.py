"""Line dedup against all pairs by edit distance, and odd rows."""

import random

from pyspark.sql import functions as F

from plumbline.llm.line_dedup import dedup_lines


def one_edit(a, b):
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) <= 1 and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])


def brute_force(rows, least):
    places = [(d, k, line) for d, t in rows if t is not None for k, line in enumerate(t.split("\n")) if line.strip(" \t\r\x0b\x0c")]
    gone = {(d, k) for d, k, x in places for e, j, y in places
            if (e, j) < (d, k) and (x == y or (min(len(x), len(y)) >= least and one_edit(x, y)))}
    return {d: None if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}


def test_against_all_pairs(spark, documents):
    rnd = random.Random(4)
    lines = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(6, 16))) for _ in range(12)]

    def changed(x):
        k = rnd.randrange(len(x))
        return rnd.choice([x, x, x[:k] + x[k + 1 :], x[:k] + "b" + x[k:], x[:k] + "a" + x[k + 1 :], x[:k] + "aa" + x[k + 2 :]])

    rows = [(k, "\n".join(changed(rnd.choice(lines)) for _ in range(rnd.randint(0, 6)))) for k in range(60)]
    rows += [(70, "aaaaaaaaaa\naaaaaaaaa\n\n \nx"), (71, "x\naaaaaaaaaaaa\naaaaaaaaaaa"), (72, None), (73, "\n\n"), (74, "x")]
    got = dedup_lines(documents(rows), min_chars=8)
    assert got.columns[:2] == ["doc_id", "text"] and got.first()["place"] == "theirs"
    assert {r["doc_id"]: r["text"] for r in got.collect()} == brute_force(rows, 8)


def test_counts_and_odd_rows(spark, documents):
    hot = "one very common line that every document has"
    rows = [(k, f"{hot}\nown line number {k * 1001} of this document\n") for k in range(50)] + [(60, hot), (None, hot), (61, None), (62, "short\nshort\nshorm")]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(documents(rows)).collect()}
    assert got[60] == ("", 1, 1) and got[None] == (hot, 0 + 1, 0) and got[61] == (None, 0, 0)
    assert got[0][1:] == (2, 0) and got[7] == ("own line number 7007 of this document\n", 2, 1)
    assert got[62] == ("short\nshorm", 3, 1)
    twice = dedup_lines(documents([(1, "a line\na line"), (1, "a line\na line")])).collect()
    assert [r["text"] for r in twice] == ["a line", "a line"]
    assert dedup_lines(documents([])).count() == 0


def test_long_line(spark, documents):
    line = "word " * 4000
    rows = [(1, line), (2, line[:9000] + "x" + line[9000:]), (3, line[:9000] + "xyz" + line[9000:])]
    got = {r["doc_id"]: r["n_removed"] for r in dedup_lines(documents(rows)).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_no_python_in_the_plan(spark, documents):
    plan = dedup_lines(documents([(1, "a line of some length, repeated"), (2, "a line of some length, repeated")]))._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_a_text_is_split_once_a_row(spark, documents):
    """Not once for each line that stays, nor for each line that is tested for being blank."""
    plan = dedup_lines(documents([(1, "a line\n \t\r\x0b\x0c\nanother line"), (2, "a line\nmore")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "get(split(" not in plan and "split(text" in plan and "translate(" not in plan
    rows = [(1, "a line\n \t\r\x0b\x0c\n\u00a0\nanother line"), (2, "\x0c\na line\nmore\x0b\n\n")]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(documents(rows)).collect()}
    assert got == {1: (rows[0][1], 3, 0), 2: ("\x0c\nmore\x0b\n\n", 2, 1)}
