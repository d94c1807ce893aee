import itertools
import random

from polyeval.llm import op6_chat as c

SCHEMA = "conv_id long, turn long, role string, text string, block long, m string, cost long"


def least(roles):
    best = None
    for targets in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, s = sum(0 if t == r else 1 if r is None else 2 for t, r in zip(targets, roles)), 0
        for t in targets:
            if t in c.NEXT[s]:
                pass
            elif t == s:
                cost += 1
            elif any(t in c.NEXT[b] for b in c.NEXT[s]):
                cost += 3
            else:
                break
            s = t
        else:
            cost += c.ending(s)[0]
            best = cost if best is None else min(best, cost)
    return best


def total(roles):
    cost, _ = c.repair(roles, c.BEGIN)
    return min(cost[s] + c.ending(s)[0] for s in range(4))


def legal(roles):
    body = roles.removeprefix("s")
    return len(body) % 2 == 0 and body == "ua" * (len(body) // 2)


def test_least_cost_by_enumeration():
    r = random.Random(1)
    for _ in range(300):
        roles = [r.choice([None, 1, 2, 3]) for _ in range(r.randint(1, 6))]
        assert total(roles) == least(roles), roles


def test_conversations(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 0, "assistant", "hi"), (2, 1, "user", "x"), (2, 0, "user", "w"),
            (3, 0, "bot", None), (3, None, None, ""), (4, 0, "system", "s <|im_end|>"), (None, 0, "user", "n"), (0, 1, "assistant", "a")]
    df = spark.createDataFrame([(*x, 9, "m", 1) for x in rows], SCHEMA)
    parts = sorted(c.format_chats(df).collect(), key=lambda r: r.block)
    assert sum(r.n_turns for r in parts) == len(rows)
    assert all(legal("".join(r.roles for r in parts if r.conv_id == i)) for i in (0, 1, 2, 3, 4, None))
    assert len([r for r in parts if r.conv_id == 3]) == 2  # a null turn is in the last block
    got = {r.conv_id: r for r in parts}
    assert got[0].rendered == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na\n\na<|im_end|>\n"
    assert got[1].roles == "ua" and got[1].n_inserted + got[1].n_relabelled > 0
    assert got[2].rendered.startswith("<|im_start|>user\nw")
    assert got[4].rendered.count("<|im_end|>") == len(got[4].roles)
    assert c.format_chats(df.limit(0)).count() == 0


def test_a_long_conversation_in_blocks(spark, monkeypatch):
    r = random.Random(2)
    rows = [(7, i, r.choice(["user", "assistant", "system", None, "tool"]), f"t{i}.", 0, "", 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(c, "BLOCK_BITS", 2)
    monkeypatch.setattr(c, "FAN_BITS", 2)
    parts = sorted(c.format_chats(df).collect(), key=lambda x: x.block)
    assert len(parts) == 50
    assert sum(p.cost for p in parts) == total([c.role_of(x[2]) for x in rows])
    assert legal("".join(p.roles for p in parts))
    text = "".join(p.rendered for p in parts)
    assert text.count("<|im_start|>") == text.count("<|im_end|>\n") == sum(len(p.roles) for p in parts)
    assert all(f"t{i}." in text for i in range(200))
