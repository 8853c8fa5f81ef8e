import random
import re

import pytest

from sievewright.llm import quote_threads as chat


def brute(rows):
    """Links by looking at every earlier message; rows: (conv, turn, role, text)."""

    def units(own):
        parts = [own, *re.split(r"\n\s*\n", own), *re.split(r"[\r\n]+", own)]
        return {" ".join(p.lower().split()) for p in parts} - {""}

    messages = []
    for conv, turn, role, text in rows:
        own, passages = chat.parse((text or "").encode())
        messages.append((conv, turn, role, own.decode() if text is not None else None, [(lv, p.decode()) for lv, p in passages]))
    said = [units(m[3] or "") for m in messages]
    parent, linked = {}, {}
    for i, (conv, turn, _, _, passages) in enumerate(messages):
        options = []
        for no, (level, passage) in enumerate(passages):
            parts = [p for p in dict.fromkeys([" ".join(passage.lower().split()), *(" ".join(x.lower().split()) for x in passage.split("\n"))]) if p]
            best = []
            for k, part in enumerate(parts):
                who = [j for j in range(len(messages)) if part in said[j] and None not in messages[j][:2]]
                if None in (conv, turn) or not who:
                    continue
                near = [j for j in who if messages[j][0] == conv]
                if near and messages[min(near, key=lambda j: messages[j][1])][1] < turn:
                    best.append((level, k, no, 0, min(near, key=lambda j: messages[j][1])))
                else:
                    j = min(who, key=lambda j: messages[j][:2])
                    if messages[j][:2] < (conv, turn):
                        best.append((level, k, no, 1, j))
            if best:
                linked[i] = linked.get(i, 0) + 1
                options.append(min(best))
        if options:
            parent[i] = min(options)[-1]
    out = []
    for i, (conv, turn, role, own, passages) in enumerate(messages):
        start, depth = i, 0
        while start in parent:
            start, depth = parent[start], depth + 1
        p = messages[parent[i]][:2] if i in parent else (None, None)
        out.append((conv, turn, role, own, *p, *messages[start][:2], depth, len(passages), linked.get(i, 0)))
    return out


def fields(r):
    return (r.conv_id, r.turn, r.role, r.content, r.parent_conv, r.parent_turn, r.thread_conv, r.thread_turn, r.depth, r.n_quotes, r.n_linked)


def run(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").write.parquet(f"{tmp_path}/conversations.parquet")
    return chat.op10_quote_threads(spark, str(tmp_path)).collect()


def test_random_threads_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows, bodies = [], []
    for conv in range(6):
        for turn in range(25):
            own = "\n".join(f"Line {rng.randint(0, 400)} of {conv}" for _ in range(rng.randint(1, 4)))
            text = own
            if bodies and rng.random() < 0.7:
                c, t, quoted = rng.choice([b for b in bodies if b[0] == conv] or bodies) if rng.random() < 0.8 else rng.choice(bodies)
                mark = rng.choice([">", "> ", " >"])
                text = "\n".join(mark + (">" if line.startswith(">") else "") + line.upper() for line in quoted.split("\n")) + "\n" + own
            bodies.append((conv, turn, text))
            rows.append((conv, turn, "user" if turn % 2 else "assistant", text))
    rng.shuffle(rows)
    got = run(spark, tmp_path, rows)
    assert sorted(map(fields, got), key=str) == sorted(brute(rows), key=str)
    by = {}
    for r in got:
        by.setdefault(r.conv_id, {})[r.turn] = r
    for conv in by.values():
        assert sorted(r.position for r in conv.values()) == list(range(len(conv)))
        for r in conv.values():
            if r.parent_conv == r.conv_id and r.thread_conv == r.conv_id:
                assert conv[r.parent_turn].position < r.position
    assert max(r.depth for r in got) > 3 and any(r.parent_conv not in (None, r.conv_id) for r in got)


def test_nested_levels():
    text = b"reply\r\n> outer\r\n>> inner one\r\n> > inner two\r\n> outer again\n  code > not a quote\n>\n"
    own, passages = chat.parse(text)
    assert own == b"reply\n  code > not a quote"
    assert passages == [(1, b" outer"), (2, b" inner one\n inner two"), (1, b" outer again"), (1, b"")]
    assert chat.parse(b"no quotes\r\n at all ") == (b"no quotes\r\n at all ", [])


def test_awkward_rows(spark, tmp_path):
    rows = [
        (1, 0, "user", "hello there"),
        (1, 1, "assistant", "> hello   THERE\nhi"),
        (1, 2, None, None),
        (1, 3, "user", ""),
        (None, 4, "user", "> hello there\nlost"),
        (1, None, "user", "> hello there\nlost"),
        (2, 0, "user", "> hello there\nfrom afar"),
        (2, 1, "user", "> never said\n> hi\nx"),
        (3, 0, "user", "> > hello there"),
        (4, 0, "user", "w " * 50_000),
        (4, 1, "user", ">" + "w " * 50_000),
        (5, 7, "user", "> same\nsame"),
    ]
    assert sorted(map(fields, run(spark, tmp_path, rows)), key=str) == sorted(brute(rows), key=str)


def test_repeated_rows_and_long_chains(spark, tmp_path):
    rows = [(1, 0, "user", "m0")] + [(1, i, "user", f"> m{i - 1}\nm{i}") for i in range(1, 40)] + [(1, 0, "user", "m0")]
    got = run(spark, tmp_path, rows)
    assert max(r.depth for r in got) == 39 and len(got) == 41
    assert sorted(r.position for r in got) == list(range(41))


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "alone")]])
def test_few_rows(spark, tmp_path, rows):
    assert len(run(spark, tmp_path, rows)) == len(rows)


def test_rewrapped_paragraphs_of_a_longer_message(spark, tmp_path):
    said = "first words\nof one\n\nsecond words\nof two\n\nthird words"
    rows = [(1, 0, "user", said), (1, 1, "assistant", "> second\n> words of two\n>\n> first words of\n> one\nreply")]
    got = {r.turn: r for r in run(spark, tmp_path, rows)}
    assert (got[1].parent_conv, got[1].parent_turn, got[1].n_linked) == (1, 0, 1)
