import hashlib
import json
import random

from pyspark.sql import functions as F

from tabwarden.llm import chat, queries

from .helpers import save

ROWS = "conv_id long, turn long, role string, text string"


def escaped(text):
    text = text.replace("\\", "\\\\")
    for s in chat.CONTROL:
        text = text.replace(s, s[0] + "\\" + s[1:])
    return text


def formatted(turns):
    return "".join(f"{chat.START}{escaped(r)}{chat.SEP}{escaped(t)}{chat.END}\n" for r, t in turns)


def test_query_matches_brute_force(spark, tmp_path):
    r = random.Random(4)
    parts = ["</s>", "[INST]", "[/INST]", "<s>", "<|im_end|>\n", "<|im_start|>", "<|im_sep|>", "\\", "\\\\", "<", "[", "<<SYS>>", "é\U0001f600", " text ", "\n", "<\\s>", "$1", "|im_end|>"]
    rows = []
    for c in range(60):
        for t in range(r.choice([1, 2, 5, 30])):
            rows.append((c, t, r.choice(["user", "assistant", "system", "to\\ol<|im_sep|>"]), r.choice([None, "", *["".join(r.choice(parts) for _ in range(r.choice([1, 4, 40]))) for _ in range(4)]])))
    rows += [(100, t, ["user", "assistant"][t % 2], "long " * 20_000 if t == 3 else f"t{t}") for t in range(700)] + [(101, 0, None, None), (102, 1, "user", "same"), (102, 1, "user", "same"), (102, None, "assistant", "first")]
    r.shuffle(rows)
    sf = save(spark, tmp_path, conversations=spark.createDataFrame(rows, ROWS))
    got = {x.conv_id: x for x in queries.op1_chat_formatting(spark, sf).collect()}
    by = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns = [x[1:] for x in sorted(turns)]
        learnt = "".join(t for role, t in turns if role == "assistant")
        x = got[c]
        assert x.n_turns == len(turns) and x.formatted_chars == len(formatted(turns)), c
        assert x.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (x.loss_chars, x.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_layouts_by_fingerprint(spark):
    records = {
        1: {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": None}], "id": 5},
        2: {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        3: {"prompt": "q", "response": "a", "extra": {"prompt": "x"}},
        4: {"instruction": "do", "input": "", "output": "a"},
        5: {"instruction": "do", "input": "this", "output": "a"},
        6: {"question": "q", "answer": "a", "turn": None} | {},
        7: {"unknown": 1},
        8: {"turns": [{"speaker": "bot", "text": "hi"}]},
        9: {"system": "", "prompt": "q", "response": "a"},
        10: {"messages": [{"role": "user"}, {"role": "tool", "content": "[1]"}, {"role": "gpt", "content": [{"type": "text", "text": "x"}, {"type": "image"}, {"type": "text", "text": "y"}]}], "prompt": "p"},
        11: {"data": {"messages": [{"role": "user", "content": "q"}]}, "id": 1},
        12: {"prompt": "q", "response": "a", "system": "s", "input": "i"},
        13: {"messages": []},
        14: {"turn": 3, "role": "gpt", "text": "verbatim"},
        15: {"system": "s", "instruction": "do", "output": None},
        16: {"record": {"prompt": "q", "completion": "c"}},
        17: {"messages": "no list", "prompt": "q", "response": "a"},
    }
    del records[6]["turn"]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in records.items()] + [(20, "{broken"), (21, None)], "id long, record string")
    got = {}
    for r in chat.canonical_turns(df, "id", "record").orderBy("id", "position").collect():
        got.setdefault(r.id, [r.layout]).append((r.role, r.text))
    assert got[1] == ["messages", ("system", "s"), ("user", "q"), ("assistant", "")]
    assert got[2] == ["share", ("user", "q"), ("assistant", "a")]
    assert got[3] == ["prompt and response", ("user", "q"), ("assistant", "a")]
    assert got[4][1:] == [("user", "do"), ("assistant", "a")] and got[5][1:] == [("user", "do"), ("user", "this"), ("assistant", "a")]
    assert got[6] == ["question", ("user", "q"), ("assistant", "a")] and got[8] == ["dialogue", ("assistant", "hi")] and got[9][1:] == [("user", "q"), ("assistant", "a")]
    assert got[7] == got[20] == got[21] == [None, (None, None)]
    assert got[10] == ["messages", ("user", ""), ("tool", "[1]"), ("gpt", "xy")] and got[11] == ["messages", ("user", "q")]
    assert got[12][1:] == [("system", "s"), ("user", "q"), ("user", "i"), ("assistant", "a")] and got[14] == ["turn rows", ("gpt", "verbatim")]
    assert got[15][1:] == [("system", "s"), ("user", "do"), ("assistant", "")] and got[16] == ["prompt and completion", ("user", "q"), ("assistant", "c")]
    assert got[17] == ["prompt and response", ("user", "q"), ("assistant", "a")]
    why = {r.id: r.reason for r in chat.canonical_turns(df, "id", "record").where("reason IS NOT NULL").collect()}
    unread = "texts that its layout does not read: "
    assert why == {7: "no layout has its fields", 10: unread + "prompt", 13: "no turns", 17: unread + "messages", 20: "no JSON object", 21: "no record"}
    made = {r.id: r.formatted for r in chat.format_chats(chat.canonical_turns(df, "id", "record")).collect()}
    assert made[7] == "" and made[3] == formatted([("user", "q"), ("assistant", "a")])


def test_fingerprints_differ_and_nothing(spark):
    every = [f for x in chat.LAYOUTS for f in x.fingerprints]
    assert len(set(every)) == len(every)
    df = spark.createDataFrame([(json.dumps({"messages": [{"role": "r"}, {"content": "c", "more": 1}], "x": 0}),)], "record string")
    layout = next(x for x in chat.LAYOUTS if x.name == "messages")
    paths = chat.field_paths(F.col("record"))
    assert sorted(df.select(paths).first()[0]) == ["messages", "messages[].content", "messages[].more", "messages[].role", "x"]
    assert df.select(chat.fingerprint(paths, layout)).first()[0] == layout.fingerprints[0]
    odd = df.select(F.lit(1).alias("id"), "record", F.lit("x").alias("layout"), F.lit("y").alias("place"), F.lit("z").alias("reason"))
    assert [(r.role, r.text) for r in chat.canonical_turns(odd, "id", "record").orderBy("position").collect()] == [("r", ""), ("", "c")]
    none = spark.createDataFrame([], "id long, record string")
    assert chat.format_chats(chat.canonical_turns(none, "id", "record")).count() == 0


def test_no_text_is_lost_without_a_word(spark):
    said = '[{"role": "user", "content": "a"}]'
    records = {
        1: f'{{"messages": {said}, "system": "sys"}}', 2: f'{{"messages": {said}, "prompt": "lost?"}}', 3: '{"messages": []}', 4: f'{{"messages": {said}, "system": ""}}',
        5: '{"prompt": "p", "response": "r", "output": "o"}', 6: f'{{"messages": {said}, "id": 3}}', 7: '{"data": {"conversations": [{"from": "gpt", "value": "v"}], "system": "s"}}',
    }
    df = spark.createDataFrame(list(records.items()), "position long, record string").withColumn("turns", F.lit("x"))
    got = {}
    for r in sorted(chat.canonical_turns(df, "position", "record").collect(), key=lambda r: (r.id, r.position if r.position is not None else 0)):
        got.setdefault(r.id, []).append((r.role, r.text, r.reason))
    assert got[1] == [("system", "sys", None), ("user", "a", None)] and got[4] == got[6] == [("user", "a", None)]
    assert got[2] == [("user", "a", "texts that its layout does not read: prompt")] and got[3] == [(None, None, "no turns")]
    assert got[5] == [(x, y, "texts that its layout does not read: output") for x, y in (("user", "p"), ("assistant", "r"))]
    assert got[7] == [("system", "s", None), ("assistant", "v", None)]
