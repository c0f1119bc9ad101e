"""Perspective rotation against a rendering in plain Python."""

from collections import defaultdict

from strata.llm import chat_formatting as C


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "unknown", (text or "").replace("<|", "< |")))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        for who in {r for *_, r, _ in turns} - {"system"}:
            at = 0
            for i, (*_, role, text) in enumerate(turns):
                head = ("<|assistant|>" if role == who else "<|system|>" if role == "system"
                        else f"<|user name={role}|>") + "\n"
                seg = head + text + "<|end|>\n"
                mask = (at + len(head), at + len(seg) - 1) if role == who else (None, None)
                out.append((conv, who, i, seg, at, *mask))
                at += len(seg)
    return sorted(out, key=str)


ROWS = [(1, 0, "user", "hi"), (1, 1, "anna", "é 日本"), (1, 2, "user", None), (1, 2, "user", None), (2, 0, "system", "s"),
        (3, None, None, "<|assistant|> spoof"), (3, 5, "bob", ""), (None, 1, "a", "x"), (None, 2, "b", "y"),
        (4, 1, "a", "long " * 40000), (4, 1, "a", "tie"), (4, 1, "b", "tie"), (2, 3, "system", "t")]


def run(spark, rows):
    turns = spark.createDataFrame([(*r, 9) for r in rows],
                                  "conv_id long, turn long, role string, text string, position int")
    return sorted([tuple(r) for r in C.perspectives(turns).collect()], key=str)


def test_odd_rows(spark):
    assert run(spark, ROWS) == brute(ROWS)
    assert run(spark, []) == []


def test_one_conversation_with_most_turns(spark):
    rows = [(7 if i % 3 else i, i // 2, ("user", "anna", "bob")[i % 3 if i % 5 else 0], f"t{i}") for i in range(3000)]
    got = run(spark, rows)
    assert got == brute(rows)
    dialogue = "".join(r[3] for r in sorted((r for r in got if r[:2] == (7, "anna")), key=lambda r: r[2]))
    for r in got:
        if r[:2] == (7, "anna") and r[5] is not None:
            assert dialogue[r[5]:r[6]].startswith("t") and dialogue[r[5]:r[6]].endswith("<|end|>")
