"""Tool-call linking against a plain walk of each conversation."""

import json
import random

import pytest

from sheafline.llm import chat

TOOLS = {"add": {"x": ("integer", True), "y": ("number", True), "note": ("string", False)}, "now": {}}
SCHEMA = "conv_id long, turn long, role string, text string"


def call(id_, name, arguments, needs=None):
    return {"id": id_, "name": name, "arguments": arguments} | ({"depends_on": needs} if needs is not None else {})


def says(*calls, content="ok"):
    return json.dumps({"content": content, "tool_calls": list(calls)})


def result(id_, content):
    return json.dumps({"tool_call_id": id_, "content": content})


def linked(spark, rows, tools=TOOLS):
    df = chat.link(spark.createDataFrame(rows, SCHEMA), tools)
    return df.orderBy("conv_id", "order_turn", "level", "turn", "item").collect()


def test_order_errors_and_json(spark):
    rows = [
        (1, 0, "user", 'hi "x"\n é\\'), (1, 1, "tool", result("b", {"z": 1, "a": [1, 2.5, None]})),
        (1, 2, "assistant", says(call("a", "add", {"y": 2, "x": 1}), call("b", "add", {"x": "1", "q": 3}, ["a"]))), (1, 3, "tool", result("a", 3)), (1, 4, "tool", result("zz", "é")),
    ]
    got = linked(spark, rows)
    assert [(r["kind"], r["call_id"], r["errors"]) for r in got] == [
        ("message", None, []), ("message", None, []), ("call", "a", []), ("call", "b", ["missing y", "unexpected q", "x is not integer"]), ("result", "b", []), ("result", "a", []),
        ("result", "zz", ["no call"]),
    ]
    assert [r["json"] for r in got] == [
        json.dumps({"content": 'hi "x"\n é\\', "role": "user"}, ensure_ascii=False, separators=(",", ":")), '{"content":"ok","role":"assistant"}',
        '{"arguments":{"x":1,"y":2},"id":"a","name":"add","type":"function"}', '{"arguments":{"q":3,"x":"1"},"depends_on":["a"],"id":"b","name":"add","type":"function"}',
        '{"content":{"a":[1,2.5,null],"z":1},"role":"tool","tool_call_id":"b"}', '{"content":3,"role":"tool","tool_call_id":"a"}', '{"content":"é","role":"tool","tool_call_id":"zz"}',
    ]


def test_edge_cases(spark):
    rows = [
        (2, 0, "assistant", says(call("p", "add", {"x": 1, "y": 1}, ["q"]), call("q", "nope", {}, ["p"]), call("p", "now", {}), call("r", "add", [1], ["gone"]), call(None, "now", {}))),
        (2, 1, "assistant", "{not json"), (2, 2, "assistant", '{"content": "only"}'), (3, None, None, None), (None, 1, "assistant", says(call("a", "now", {}))), (None, 2, "tool", result("a", 1)),
        (4, 0, "tool", "plain"), (5, 0, "user", "twice"), (5, 0, "user", "twice"), (6, 0, "user", "x" * 100_000),
    ]
    got = linked(spark, rows)
    errors = {(r["conv_id"], r["item"]): r["errors"] for r in got if r["kind"] == "call"}
    assert errors[(2, 1)] == ["cycle", "no result"] and errors[(2, 2)] == ["cycle", "no result", "unknown tool"] and errors[(2, 3)] == ["cycle", "no result", "repeated id"]
    assert errors[(2, 4)] == ["arguments are not an object", "no result", "unknown dependency"] and errors[(2, 5)] == ["no id"] and errors[(None, 1)] == ["no result"]
    plain = {(r["conv_id"], r["turn"]): r["json"] for r in got if r["kind"] == "message"}
    assert plain[(2, 1)] == '{"content":"{not json","role":"assistant"}' and plain[(3, None)] == '{"content":"","role":""}'
    assert [r["errors"] for r in got if r["conv_id"] == 4] == [["no id"]] and len([r for r in got if r["conv_id"] == 5]) == 2
    assert linked(spark, []) == []


def test_random_graphs_are_ordered(spark):
    rng, rows, needs = random.Random(5), [], {}
    for conv in range(25):
        ids = [f"c{i}" for i in range(rng.randint(1, 8))]
        turn = 0
        for i, id_ in enumerate(rng.sample(ids, len(ids))):
            # Only calls of a smaller number, so there is no cycle; turns are in any order.
            mine = rng.sample([o for o in ids if int(o[1:]) < int(id_[1:])], k=min(rng.randint(0, 2), int(id_[1:])))
            needs[(conv, id_)] = mine
            rows.append((conv, turn, "assistant", says(call(id_, "now", {}, mine))))
            turn += 1
        for id_ in ids:
            rows.append((conv, rng.randint(0, 20) + 100 * rng.randint(0, 1), "tool", result(id_, 1)))
    got = linked(spark, rows)
    place = {(r["conv_id"], r["kind"], r["call_id"]): n for n, r in enumerate(got) if r["call_id"]}
    for (conv, id_), mine in needs.items():
        assert place[(conv, "result", id_)] > place[(conv, "call", id_)]
        assert all(place[(conv, "call", id_)] > place[(conv, "call", n)] for n in mine)
    assert all(r["valid"] for r in got)


@pytest.mark.parametrize("value,kind", [(1, "integer"), (1.5, "number"), (1, "number"), ("a", "string"), (True, "boolean"), ([1], "array"), ({"a": 1}, "object"), (None, "null")])
def test_types(spark, value, kind):
    rows = [(1, 0, "assistant", says(call("a", "t", {"v": value}))), (1, 1, "tool", result("a", 0))]
    assert linked(spark, rows, {"t": {"v": (kind, True)}})[1]["errors"] == []
    other = "string" if kind != "string" else "integer"
    assert linked(spark, rows, {"t": {"v": (other, True)}})[1]["errors"] == [f"v is not {other}"]


def test_no_python_on_the_executors(spark):
    plan = chat.link(spark.createDataFrame([(1, 0, "user", "x")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_member_is_lost(spark):
    """Whatever JSON a call, a message or a result holds comes back, but for tool_calls, whose calls are rows."""
    rng = random.Random(4)
    value = lambda d=0: rng.choice([1, -2.5, "é\n\"", None, True, [1, {"b": 2, "a": []}], {"z": {"y": 1, "x": "w"}}])
    rows, want = [], {}
    for conv in range(60):
        call_ = {"id": "a", "name": "now", "arguments": {}} | {rng.choice(["depends_on", "note", "Zed", "é", "index"]): value() for _ in range(3)}
        call_ = {k: call_[k] for k in rng.sample(list(call_), len(call_)) if k == "id" or rng.random() < 0.8}
        told = {"tool_calls": [call_], "content": value(), "id": 7, "extra": value()}
        answer = {"tool_call_id": "a", "content": value(), "status": value()}
        rows += [(conv, 0, "assistant", json.dumps(told)), (conv, 1, "tool", json.dumps(answer, ensure_ascii=False, indent=1))]
        del told["tool_calls"]
        want[conv] = [told | {"role": "assistant"}, {"name": None, "arguments": None} | call_ | {"type": "function"}, answer | {"role": "tool"}]
    written = lambda v: json.dumps(v, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    got = linked(spark, rows)
    for conv in want:
        assert [r["json"] for r in got if r["conv_id"] == conv] == [written(v) for v in want[conv]]


def test_what_is_not_such_json_is_plain_content(spark):
    texts = ['{"tool_calls": [1]}', '{"tool_calls": {}}', '{"tool_calls": []}', '{"a":1,"a":2,"tool_calls":[{"id":"x"}]}', '[{"id":"x"}]', '{"content":1}']
    got = linked(spark, [(i, 0, "assistant", t) for i, t in enumerate(texts)])
    assert [json.loads(r["json"]) for r in got] == [{"content": t, "role": "assistant"} for t in texts]


def walked(turns, needs):
    """id -> (order_turn, level, cycle) by plain recursion; turns: id -> turn, needs: id -> ids."""
    state, found = {}, {}

    def bad(c, path):
        if c in state:
            return state[c]
        if c in path:
            return True
        state[c] = any([bad(n, path | {c}) for n in needs[c] if n in turns])
        return state[c]

    def place(c):
        if c not in found:
            at, level = max((place(n) for n in needs[c] if n in turns), default=(-1, 0))
            found[c] = (at, level + 1) if at >= turns[c] else (turns[c], 1)
        return found[c]

    reach = lambda c, seen: [reach(n, seen) for n in needs[c] if n in turns and n not in seen and not seen.add(n)] and seen or seen
    in_cycle = {c for c in turns if c in reach(c, set())}
    doomed = {c for c in turns if c in in_cycle or reach(c, set()) & in_cycle}
    return {c: (turns[c], 1, True) if c in doomed else (*place(c), False) for c in turns}


def test_places_against_a_plain_walk(spark):
    rng, rows, want = random.Random(6), [], {}
    for conv in range(60):
        n = rng.randint(1, 12)
        turns = {f"c{i}": rng.randint(0, 4) for i in range(n)}
        back = rng.random() < 0.3
        needs = {c: rng.sample([o for o in [*turns, "gone"] if back or o == "gone" or int(o[1:]) < int(c[1:])], k=min(rng.randint(0, 2), int(c[1:]))) for c in turns}
        rows += [(conv, t, "assistant", says(call(c, "now", {}, needs[c]))) for c, t in turns.items()]
        want |= {(conv, c): v for c, v in walked(turns, needs).items()}
    got = {(r["conv_id"], r["call_id"]): (r["order_turn"], r["level"], "cycle" in r["errors"]) for r in linked(spark, rows) if r["kind"] == "call"}
    assert got == want and any(v[2] for v in want.values()) and any(v[1] > 2 for v in want.values())


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, write = [], chat.Scratch.write
    monkeypatch.setattr(chat.Scratch, "write", lambda self, df: rounds.append(1) or write(self, df))
    n = 1000
    rows = [(1, 0, "assistant", says(*[call(f"c{i}", "now", {}, [f"c{i + 1}"] if i + 1 < n else []) for i in range(n)]))]
    got = [r["call_id"] for r in linked(spark, rows) if r["kind"] == "call"]
    assert got == [f"c{i}" for i in reversed(range(n))] and len(rounds) < 40


def test_the_query_equals_its_sql(spark):
    import duckdb
    from conftest import DATA

    from sheafline.llm import queries

    base = duckdb.connect()
    base.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    found = queries.op8_tool_call_linking(spark, DATA)
    want = base.execute(queries.ORACLES["op8_tool_call_linking"]).to_arrow_table()
    assert sorted(found.columns) == sorted(want.column_names)
    rows = sorted(map(str, want.select(found.columns).to_pylist()))
    assert sorted(str(r.asDict()) for r in found.collect()) == rows and len(rows) > 100
    assert {"call", "message", "result"} == {r["kind"] for r in want.to_pylist()}
