import json

from learnstream.llm import chat

TOOLS = {"f": {"type": "object", "required": ["a"], "additionalProperties": False,
               "properties": {"a": {"type": "integer", "minimum": 0}, "b": {}, "s": {"type": "string", "maxLength": 3}}}}


def call(i, name="f", args=None, **more):
    return json.dumps({"tool_calls": [{"id": i, "name": name, "arguments": {"a": 1} if args is None else args}], **more})


def result(i, content="r"):
    return json.dumps({"tool_call_id": i, "content": content})


def ref(i):
    return {"$ref": i}


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, level int")
    return chat.link(df, TOOLS).collect()


def test_links_levels_and_duplicates(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", call("x", args={"a": ref("y")})),
            (1, 2, "assistant", call("y", args={"a": ref("z"), "b": [ref("w")]})), (1, 3, "assistant", call("z")),
            (1, 4, "assistant", call("w", args={"b": ref("z"), "a": 2})), (1, 5, "tool", result("x")),
            (1, 6, "tool", result("x")), (1, 7, "tool", result("nobody")), (1, 8, "assistant", call("z")),
            (2, 0, "assistant", call("p", args={"a": ref("q")})), (2, 1, "assistant", call("q", args={"a": ref("p")})),
            (2, 2, "assistant", call("behind", args={"a": ref("p")})), (2, 3, "assistant", call("lost", args={"a": ref("x")}))]
    got = {(r.conv_id, r.turn): (r.status, r.level) for r in run(spark, rows)}
    assert got == {(1, 0): (None, None), (1, 1): ("linked", 3), (1, 2): ("no_result", 2), (1, 3): ("no_result", 0),
                   (1, 4): ("no_result", 1), (1, 5): ("linked", 3), (1, 6): ("duplicate", 3), (1, 7): ("no_call", None),
                   (1, 8): ("duplicate", 0), (2, 0): ("no_result", None), (2, 1): ("no_result", None),
                   (2, 2): ("no_result", None), (2, 3): ("no_result", None)}


def test_validation_and_canonical_json(spark):
    rows = [(1, 0, "a", call("1", args={"s": "long", "a": -1, "z": None})), (1, 1, "a", call("2", "g")),
            (1, 2, "a", call("3", args="{\"a\": 1.0}")), (1, 3, "a", call("4", args={"a": 1.5})),
            (1, 4, "a", call("5", args={}, content="é"))]
    got = {(r.turn, r.nth): r for r in run(spark, rows)}
    assert got[0, 0].errors == "$.a: below 0;$.s: longer than 3;$.z: not allowed"
    assert got[1, 0].errors == "unknown tool g" and got[2, 0].errors == ""
    assert got[3, 0].errors == "$.a: number is not integer" and got[4, 0].errors == "$.a: missing"
    assert got[0, 0].json == '{"arguments":{"a":-1,"s":"long","z":null},"id":"1","name":"f"}'
    assert got[4, 1].json == '{"content":"é","role":"a"}' and got[4, 1].kind == "message"


def test_odd_rows_and_empty_table(spark):
    rows = [(None, None, None, None), (None, 1, "a", call("1")), (None, 2, "t", result("1")), (3, 1, "a", "{"),
            (3, 2, "a", "[1]"), (3, 3, "a", '{"tool_calls": 1}'), (3, 4, "a", ""), (3, 5, "t", result(None)),
            (3, 6, "a", "x" * 100_000), (3, 7, "a", call("d")), (3, 7, "a", call("d"))]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert [r.status for r in got if r.conv_id is None and r.kind != "message"] == ["linked", "linked"]
    assert sorted(r.status for r in got if r.turn == 7) == ["duplicate", "no_result"]     # equal rows
    assert [r.status for r in got if r.turn == 5] == ["no_call"]
    assert run(spark, []) == []


def test_derived_conversations_link_as_by_hand(spark, small):
    conv = spark.read.parquet(f"{small}/conversations.parquet")
    got = {(r.conv_id, r.turn): r for r in chat.link(chat.derived(conv), chat.TOOLS).collect()}
    rows = {(r.conv_id, r.turn): r for r in conv.collect()}
    assert set(got) == set(rows)
    words = {k: (r.text or "").count(" ") + 1 for k, r in rows.items()}
    calls = {k for k, r in rows.items() if r.role == "assistant"}

    def level(k, path=()):
        if k not in calls or k in path:
            return None
        w = words[k]
        to = (k[0], k[1] - 2) if w % 3 == 0 else (k[0], k[1] + 2) if w % 7 == 1 else None
        if to is None:
            return 0
        below = level(to, (*path, k))
        return None if below is None else below + 1

    for k in calls:
        behind = rows.get((k[0], k[1] + 1))
        assert got[k].kind == "call" and got[k].level == level(k)
        assert got[k].status == ("linked" if behind is not None and behind.role == "user" else "no_result")
        w = words[k]
        assert ("unknown tool" in got[k].errors) == (w % 11 == 5)
        body = json.loads(got[k].json)
        assert body["arguments"]["limit"] == w and body["arguments"]["query"] == (rows[k].text or "")
        assert got[k].json == chat.canonical(body)


def test_hostile_json_is_a_plain_message(spark):
    call = '{"tool_calls":[{"id":"a","name":"search","arguments":%s}]}'
    texts = [call % '"\\ud800"', call % ("[" * 3000 + "]" * 3000), call % '{"limit":NaN}', call % '{"limit":1e999}',
             '{"tool_call_id":"\\udfff","content":1}', '{"tool_call_id":"a","content":Infinity}', '{"a":' * 5000,
             call % ("1" * 5000), '{"tool_calls":[{"id":"\\ud83d","name":"x"}]}']
    rows = [(1, k, "assistant", t) for k, t in enumerate(texts)]
    got = chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chat.TOOLS).collect()
    assert sorted((r.turn, r.kind) for r in got) == [(k, "message") for k in range(len(texts))]
    assert all(json.loads(r.json)["content"] == texts[r.turn] for r in got)
