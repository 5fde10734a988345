import random
import re

import pytest

from vitrina.llm.quote_links import parse, reply_ordered

SCHEMA = "conv_id bigint, turn bigint, role string, text string, extra int, thread string"


def brute(rows):
    """reply_to, thread and depth by looking at every earlier message."""
    out = {}
    for conv, turn, *_ in rows:
        me = [parse(r[3]) for r in rows if r[:2] == (conv, turn)]
        votes = {}
        for _, _, quotes in me:
            for level, _, keys in {(q[0], q[1], tuple(q[2])) for q in quotes}:
                found = {}
                for k in keys:
                    have = [r[1] for r in rows if r[0] == conv and r[1] is not None and turn is not None
                            and r[1] < turn and k in parse(r[3])[1]]
                    if have:
                        found[max(have)] = found.get(max(have), 0) + 1
                if found and level == 1:
                    best = max(found, key=lambda t: (found[t], t))
                    votes[best] = votes.get(best, 0) + found[best]
        out[conv, turn] = max(votes, key=lambda t: (votes[t], t)) if votes else None
    return out


ROWS = [
    (1, 0, "user", "Hello there\nHow are you?", 1, "x"),
    (1, 1, "assistant", "Fine, thanks.", 1, "x"),
    (1, 2, "user", "On Monday A wrote:\n> hello   THERE\n> How are you?\nI ask again.", 1, "x"),
    (1, 3, "user", "> > hello there\n> I ask again.\nYes\n> Fine, thanks.", 1, "x"),
    (1, 4, "user", ">Nobody said this\nOk", 1, "x"),
    (1, 5, "user", "> Yes\ndeep", 1, "x"),
    (2, 0, "user", None, 1, "x"),
    (2, 1, None, "", 1, "x"),
    (2, 1, "user", "> Hello there", 1, "x"),
    (None, 1, "user", "> Yes", 1, "x"),
    (3, None, "user", "a > b", 1, "x"),
    (3, 2, "user", "same", 1, "x"),
    (3, 2, "user", "same", 1, "x"),
    (3, 4, "user", "same", 1, "x"),
    (3, 7, "user", "> same\n>> same\nx", 1, "x"),
]


def test_links_equal_brute_force(spark):
    rows = [r[:2] + r[2:] for r in ROWS]
    got = reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == want
    by = {(r.conv_id, r.turn): r for r in got}
    assert (by[1, 5].thread, by[1, 5].depth) == (0, 3)
    assert by[1, 2].text == "I ask again." and by[1, 4].text == "Ok" and by[1, 3].text == "Yes"
    assert by[1, 0].text == ROWS[0][3] and by[3, None].text == "a > b"
    assert by[1, 0].chat == "<|user|>\nHello there\nHow are you?\n<|end|>"
    for r in got:  # an answer stands after what it answers
        if r.reply_to is not None:
            assert by[r.conv_id, r.reply_to].thread == r.thread and r.reply_to < r.turn


def test_empty_table(spark):
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text, levels", [(">a\n> b\n>> c\nd", [1, 2]), ("no", []), ("  > x", [1]), ("> > >y", [3])])
def test_levels(text, levels):
    assert [q[0] for q in parse(text)[2]] == levels


def plain(text):
    """Words and marks in small letters, one blank between them."""
    return " " + " ".join(re.findall(r"\w+|[^\w\s]", text.lower())) + " "


def parts(text):
    """The whole, the lines and the sentences of a message's own text."""
    return {plain(p) for p in (text, *text.split("\n"), *re.split(r"(?<=[.!?])\s+", text.replace("\n", " ")))}


def source(messages, turn, quote):
    """The nearest earlier message that has the quote as a part of its own, else anywhere in its text."""
    earlier = [(t, own) for t, own in messages if t < turn]
    same = [t for t, own in earlier if plain(quote) in parts(own)]
    inside = [t for t, own in earlier if plain(quote) in plain(own)]
    return max(same) if same else max(inside) if inside else None


def test_partial_quotes_equal_substring_search(spark):
    """Quotes of any run of words, cut into lines of their own, against a search of every earlier text."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(14)]
    rows, want = [], {}
    for conv in range(6):
        messages = []
        for turn in range(25):
            own = " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "?", "\n"]) for _ in range(rng.randint(3, 25)))
            quote = None
            if messages and rng.random() < 0.7:
                of = rng.choice(messages)[1].split()
                a = rng.randrange(len(of))
                quote = of[a:a + rng.randint(1, 12)]
                wrapped = "".join(w + rng.choice([" ", " ", "\n> "]) for w in quote[:-1]) + quote[-1]
                want[conv, turn] = source(messages, turn, " ".join(quote))
            rows.append((conv, turn, "user", (f"> {wrapped}\n" if quote else "") + own))
            messages.append((turn, own))
    got = reply_ordered(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {(r.conv_id, r.turn): r.reply_to for r in got.collect() if r.n_quotes}
    assert None not in want.values() and got == want


def test_partial_quotes(spark):
    rows = [("a", 0, "user", "Fine, thanks. And you? We meet at noon, then."),
            ("a", 1, "user", "One long line that the mail program wraps\nand a second line that follows it.\nEnd."),
            ("a", 2, "user", "> And you?\nWell."), ("a", 3, "user", "> meet at noon\nYes."),
            ("a", 4, "user", "> One long line that the\n> mail program wraps and a second\n> line that follows it.\nSure."),
            ("a", 5, "user", "> Nobody said so. We meet at noon, then.\nGood."), ("a", 6, "user", "> eet at noo\nNo."),
            ("b", 0, "user", "> And you?\nOther conversation."), ("b", 1, "user", "今天天气很好。你呢？"), ("b", 2, "user", "> 天气很好\nx")]
    got = reply_ordered(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    assert {(r.conv_id, r.turn): r.reply_to for r in got if r.n_quotes} == {
        ("a", 2): 0, ("a", 3): 0, ("a", 4): 1, ("a", 5): 0, ("a", 6): None, ("b", 0): None, ("b", 2): 1}
