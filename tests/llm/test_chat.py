import hashlib

from gleanrow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
CONTROL = ["</s>[INST] ok [/INST]", "<|turn|>user<|says|>x<|end|>", "a\\b\\\\<\\[", "<\\", "[\\\\", ""]


def digest_of(turns):
    told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_round_trip_with_control_strings_nulls_and_ties(spark):
    convs = {
        1: [("user", CONTROL[0]), ("assistant", CONTROL[1]), ("user", CONTROL[2]), ("assistant", CONTROL[3])],
        2: [("system", None), ("user", "only"), ("user", "asks")],
        3: [("assistant", CONTROL[4])],
        4: [(None, "no role"), ("assistant", ""), ("us\ner<|says|>", "é" * 50)],
    }
    rows = [(c, i, r, t, "clash") for c, turns in convs.items() for i, (r, t) in enumerate(turns)] + [(None, 0, "user", "null id", "x"),
        (None, 1, "assistant", "another", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    examples = chat.expand(df)
    assert examples.where("conv_id = 1").count() == 2
    assert [r["loss_start"] for r in examples.where("conv_id = 2").collect()] == [None]
    found = chat.digest(examples).collect()
    got = {r["conv_id"]: r for r in found}
    for c, turns in convs.items():
        assert tuple(got[c])[1:5] == digest_of(turns), c
    assert sorted((r["n_turns"], r["loss_chars"]) for r in found if r["conv_id"] is None) == [(1, 0), (1, 7)]
    for r in examples.collect():
        for mark in ("</s>", "[INST]"):
            assert mark not in r["formatted"]


def test_context_is_all_turns_before_and_only_the_reply_is_trained(spark):
    df = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], f"t{i}", "") for i in range(6)], SCHEMA)
    rows = chat.expand(df).orderBy("example").collect()
    assert [r["formatted"].count(chat.TURN) for r in rows] == [2, 4, 6]
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] for r in rows] == ["t1", "t3", "t5"]


def test_repeated_turns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "same", ""), (1, 0, "user", "same", ""), (1, None, "assistant", "first", "")], SCHEMA)
    row = chat.digest(chat.expand(df)).first()
    assert tuple(row)[1:5] == digest_of([("assistant", "first"), ("user", "same"), ("user", "same")])
    assert chat.digest(chat.expand(df.limit(0))).count() == 0


def test_very_long_text(spark):
    turns = [("user", "a<b [x] " * 200_000), ("assistant", "é\\<" * 300_000)]
    df = spark.createDataFrame([(1, i, r, t, "") for i, (r, t) in enumerate(turns)], SCHEMA)
    assert tuple(chat.digest(chat.expand(df)).first())[1:5] == digest_of(turns)
