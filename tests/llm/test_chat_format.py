import hashlib
import json

from paylens.llm import chat_format as chat


def records(spark, items):
    return spark.createDataFrame([(json.dumps(i) if not isinstance(i, str) else i,) for i in items], "record string")


def turns(spark, *items):
    return [(r.layout, r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_turns(records(spark, items)).collect()]


def test_layouts_become_canonical_turns(spark):
    assert turns(spark, {"id": "c", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
                 ) == [("messages", "c", 0, "user", "q"), ("messages", "c", 1, "assistant", "")]
    assert turns(spark, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}) == [
        ("from and value", None, 0, "user", "q"), ("from and value", None, 1, "assistant", "a")]
    assert turns(spark, {"instruction": "do", "input": "x", "output": "y"}) == [
        ("instruction", None, 1, "user", "do\n\nx"), ("instruction", None, 2, "assistant", "y")]
    assert turns(spark, {"id": 7, "prompt": "p", "response": "r"})[1] == ("prompt and response", "7", 1, "assistant", "r")
    assert turns(spark, {"prompt": "p", "completion": "r"})[0][0] == "prompt and completion"
    assert turns(spark, {"question": "p", "context": "c", "answer": "r"}) == [
        ("question and answer", None, 0, "system", "c"), ("question and answer", None, 1, "user", "p"),
        ("question and answer", None, 2, "assistant", "r")]
    assert turns(spark, {"conv_id": 3, "turn": 9, "role": "user", "text": "t"}) == [("turn rows", "3", 9, "user", "t")]


def test_further_fields_and_unknown_records(spark):
    extra = {"id": 1, "messages": [{"role": "user", "content": "q", "meta": {"k": [1]}}], "source": "s"}
    assert turns(spark, extra) == [("messages", "1", 0, "user", "q")]
    assert turns(spark, {"id": 1, "messages": []}) == []
    for odd in ({"title": "t"}, "not json", "[1, 2]", "null"):
        text = odd if isinstance(odd, str) else json.dumps(odd)
        assert turns(spark, odd) == [(None, None, None, None, text)]
    a, b = chat.fingerprint(["a", "b[].c"]), chat.fingerprint(["b[].c", "a", "a"])
    assert a == b != chat.fingerprint(["a", "b.c"])
    assert sorted(set(chat.paths_of({"a": [{"b": 1}, {"c": []}], "d": {}, "e": None}))) == [
        "a[].b", "a[].c[]", "d", "e"]


TEXTS = ["", "\\", "\\\\l", "</turn>", "<turn user>x</turn>", "\\### Assistant: </turn> ok", "a<b>c\\g\n", "é日𝐀"]


def test_escapes_are_reversible():
    for a in TEXTS:
        for b in TEXTS:
            assert chat.unescape(chat.escape(a + b)) == a + b
            assert "<" not in chat.escape(a + b) and ">" not in chat.escape(a + b)


def check(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segment string")
    formatted = chat.format_turns(chat.canonical_turns(chat.turn_records(frame)).filter("layout is not null"))
    got = sorted(map(tuple, chat.digests(formatted).collect()), key=str)
    expected = []
    for conversation in {r[0] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conversation))
        said = [t for _, _, role, t in mine if role == "assistant"]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((None if conversation is None else str(conversation), len(mine),
                         digest("".join(f"{role}\n{t}\n" for _, _, role, t in mine)),
                         sum(map(len, said)), digest("".join(said)),
                         sum(len(chat.escape(role)) + len(chat.escape(t)) + 14 for _, _, role, t in mine)))
    assert got == sorted(expected, key=str)
    return formatted


def test_formatted_turns_read_back(spark):
    rows = [(c, t, ["user", "assistant", "system", None, "<x>\\"][(c + t) % 5], TEXTS[(3 * c + t) % len(TEXTS)], "s")
            for c in range(12) for t in range(c + 1)]
    rows += [(None, 0, "assistant", None, "s"), (50, None, "assistant", "a", "s"), (50, 1, "assistant", "b", "s"),
             (50, 1, "assistant", "b", "s"), (50, 1, "assistant", "a", "s")]
    check(spark, rows)


def test_long_conversations_are_cut_into_segments(spark, monkeypatch):
    rows = [(1, t, "assistant" if t % 2 else "user", f"{t} <" * 40_000, "s") for t in range(40)]
    formatted = check(spark, rows)
    assert formatted.count() > 3
    assert max(len(r.formatted) for r in formatted.collect()) < 2 * chat.SEGMENT_CHARS


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.format_turns(chat.canonical_turns(chat.turn_records(frame)))).count() == 0
