import random

from pyspark.sql import functions as F

from ledgerline.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, segment string"


def brute(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    out = []
    for conv, turns in convs.items():
        low = lambda x: (x is not None, x if x is not None else 0)
        turns = sorted(turns, key=lambda r: (low(r[1]), (r[2] is not None, r[2] or ""), r[3] or ""))
        for who in {r[2] for r in turns} - {None, "system"}:
            at = 0
            for _, turn, role, text, _ in turns:
                name = role or "unknown"
                head = "assistant" if role == who else "system" if role == "system" else f"user name={name}"
                head = f"<|im_start|>{head}\n"
                seg = f"{head}{text or ''}<|im_end|>\n"
                mine = role == who
                out.append((conv, who, turn, name, seg, at, at + len(seg), at + len(head) if mine else None,
                            at + len(seg) - 1 if mine else None))
                at += len(seg)
    return sorted(out, key=repr)


def test_rotation_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for conv in [None, *range(12)]:
        for turn in range(rng.choice([1, 3, 40])):
            rows.append((conv, rng.choice([turn, turn, turn * 300, None]), rng.choice(["ann", "bob", "cy", "system", None]),
                         rng.choice([None, "", "hi", "héllo 🙂\n<|im_end|>"]), "clash"))
    rows += rows[:5]                                          # repeated rows
    got = sorted(map(tuple, C.rotate(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()), key=repr)
    assert got == brute(rows)


def test_assembled_dialogue_and_masks(spark):
    rows = [(1, 0, "system", "be kind", ""), (1, 1, "ann", "hello", ""), (1, 2, "bob", "yo", "")]
    d = {r.perspective: r for r in C.assemble(C.rotate(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert d["bob"].dialogue == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhello<|im_end|>\n"
                                 "<|im_start|>assistant\nyo<|im_end|>\n")
    assert [d["bob"].dialogue[m.start:m.end] for m in d["bob"].masks] == ["yo<|im_end|>"]
    assert [d["ann"].dialogue[m.start:m.end] for m in d["ann"].masks] == ["hello<|im_end|>"]


def test_empty_and_system_only(spark):
    assert C.rotate(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.rotate(spark.createDataFrame([(1, 0, "system", "x", "")], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    df = C.rotate(spark.createDataFrame([(1, 0, "a", "x", "")], SCHEMA).where(F.col("turn") >= 0))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
