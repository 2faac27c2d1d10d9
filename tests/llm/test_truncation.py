import random

import pytest

from rigweave.llm.truncation import find_cut, judge, open_structure, questions, units_of

SUBJECTS = ["The operator", "The reviewer", "The night shift", "The trainee"]
VERBS = ["moved the red gear to the upper bin", "checked the clock daemon before lunch", "reported a loose connector in the wrist camera", "placed the towel near the test socket"]


def sentence(rng):
    return f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)}"


def corpus(rng):
    docs, cut = [], set()
    for i in range(400):
        body = [sentence(rng) for _ in range(rng.randrange(2, 6))]
        if i % 4 == 0:
            text = "\n".join(f"[10:{j:02d}:07] {s}" for j, s in enumerate(body))
        else:
            text = ". ".join(body) + "."
        if i % 10 == 0:
            last = body[-1]
            text = text[: text.rindex(last) + len(last) // 2 + rng.randrange(3)]
            if i % 40 == 20:
                text += "..."
            elif i % 40 == 10:
                text += "\n[handed over by shift A]"
            cut.add(i)
        elif i % 10 == 1:
            text += "\n[handed over by shift A]"
        docs.append((i, text, "x"))
    docs += [(900, None, "x"), (901, "", "x"), (902, "  \n", "x"), (903, '{"a": "done."}', "x"), (904, '{"a": "done.', "x"), (905, "The review was ok. �", "x"), (906, "word " * 300_000, "x"), (907, "y" * 100_000, "x"), (903, '{"a": "done."}', "x")]
    return docs, cut | {904, 905}


def test_finds_cut_texts(spark):
    docs, cut = corpus(random.Random(9))
    df = spark.createDataFrame(docs, "doc_id long, text string, copies string")
    got = {r["doc_id"]: r["is_cut"] for r in find_cut(df).collect()}
    assert len(got) == len({d[0] for d in docs})
    assert {i for i, c in got.items() if c} - {906, 907} == cut


def test_copies_do_not_vouch(spark):
    docs, cut = corpus(random.Random(9))
    docs += [(10_000 + k * 1000 + i, t, s) for k in range(3) for i, t, s in docs if i in cut and i < 400]
    got = {r["doc_id"] for r in find_cut(spark.createDataFrame(docs, "doc_id long, text string, n string")).where("is_cut").collect()}
    assert cut <= got and all(i % 1000 in cut for i in got if i >= 10_000)


def test_empty(spark):
    assert find_cut(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text,want", [('{"a": [1, 2', True), ('{"a": "x\\"}', True), ('{"a": 1}  ', False), ("[10:00:00] log", False), ("{ curly prose", False), ("ends in half a character �", True)])
def test_open_structure(text, want):
    assert open_structure(text) is want


def test_units():
    got = units_of('OP: It moved 12 mm. "Done!" he said\n- check the cable\n重启之后。正常')
    assert [u["words"] for u in got][:2] == [["It", "moved", "00", "mm"], ['"Done']]
    assert [u["closed"] for u in got] == [True, True, False, False, True, False]
    assert questions("One. Two.") == (False, [])


def test_judge():
    assert judge([(0, 5, 0)] + [(0, 0, 0)] * 4, False, False, False) == "cut"
    assert judge([(4, 0, 0)] + [(0, 0, 0)] * 4, True, False, False) == "tail"
    assert judge([(0, 0, 0)] * 5, True, False, False) == "cut"
    assert judge([(0, 0, 0)] * 5, False, False, False) == "whole"
    assert judge([(0, 0, 0)] * 5, True, False, True) == "whole"


def test_copies_of_a_cut_line_do_not_vouch(spark):
    line = "Pick up the gear, turn it over and set it on the parts tr"
    longer = [line + rest for rest in ("ay near the socket", "ay of the left cell", "ay before the next run")]
    docs = [(i, line) for i in range(1000)] + [(1000 + i, t) for i, t in enumerate(longer)]
    docs += [(2000 + i, f"Place towel {i} on the table") for i in range(20)]
    got = {r["doc_id"] for r in find_cut(spark.createDataFrame(docs, "doc_id long, text string")).where("is_cut").collect()}
    assert got == set(range(1000))


def test_a_filter_that_rules_nothing_out_gives_the_same(spark, monkeypatch):
    import rigweave.llm.truncation as module

    docs, _ = corpus(random.Random(9))
    df = spark.createDataFrame(docs, "doc_id long, text string, n string")
    near = {(r["doc_id"], r["why"]) for r in find_cut(df).collect()}
    monkeypatch.setattr(module, "FILTER_BITS", 6)
    assert {(r["doc_id"], r["why"]) for r in find_cut(df).collect()} == near


def test_prefix_hashes_depend_on_what_precedes():
    from rigweave.llm.truncation import START, places

    words, unit, at, keys = places([["a", "b", "c"], ["z", "b", "c"], ["a", "b"], []], ["s", "s", "t", "s"])
    assert words == ["a", "b", "c", "z", "b", "c", "a", "b"] and at.tolist() == [0, 1, 2, 0, 1, 2, 0, 1]
    assert keys[0, 0] == keys[0, 3] == keys[0, 6] == START and keys[0, 1] == keys[0, 7] != keys[0, 4]
    assert keys[3, 2] == keys[3, 5] and keys[3, 1] != keys[3, 7] and keys[2, 2] != keys[2, 5] and keys[2, 1] == -1


def test_a_log_that_begins_and_ends_with_brackets_is_asked_about():
    assert questions("[10:00:07] gripper opened\n[10:00:09] moved to the\n[handed over by shift A]")[0] is None
