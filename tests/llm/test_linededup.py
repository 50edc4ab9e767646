"""Line deduplication against a plain loop, and its cases."""

import random

from flotilla.llm import linededup

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, min_chars=1):
    docs = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= min_chars and i is not None:
                docs.setdefault(key, set()).add(i)
    frequent = {k for k, v in docs.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if x.strip(SPACE).translate(LOWER) not in frequent]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(t, i, "p", "l", 1) for i, t in rows], "text string, doc_id long, pos string, lines string, h1 int").repartition(3)
    out = linededup.line_dedup(df, **kw)
    assert out.select("row.*").columns == df.columns
    return sorted(((r.row.doc_id, r.row.text, r.n_lines, r.n_dropped) for r in out.collect()), key=repr)


def test_against_a_loop(spark):
    rng = random.Random(3)
    pool = ["Common LINE", " common line\t", "ÉTÉ", "été", "", "  ", "\x0b", "rare one", "x"] + [f"line {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "Common Line"), (104, "\n".join(["common line"] * 3000 + ["own"]))]
    for n, chars in ((2, 1), (10, 1), (5, 6)):
        assert run(spark, rows, min_docs=n, min_chars=chars) == brute(rows, n, chars)


def test_repeated_ids_null_ids_and_empty_table(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (1, "a\nc"), (2, "a"), (None, "a\nd"), (None, "d"), (None, None)]
    assert run(spark, rows, min_docs=2) == brute(rows, 2)  # id 1 counts once, null ids not at all
    assert run(spark, rows, min_docs=3) == brute(rows, 3)
    assert run(spark, [], min_docs=1) == []


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = linededup.line_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
