import hashlib
import itertools
import random
import zlib

import pytest

from stopcast.llm import conversation_repair as cr

BLANK = " \t\n\x0b\x0c\r"


def break_rows(rows):
    """Rows after damage, by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        conversation = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        conversation += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    for conversation in out.values():
        conversation.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BLANK)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def all_repairs(rows, fault):
    """(cost, audit, repaired rows) of every edit sequence with at most one insertion a gap."""
    def gaps(i):
        yield 0, "", []
        for role in ("user", "assistant"):
            yield 5, "I", [(role, "")]
        yield 10, "II", [("user", ""), ("assistant", "")]
        yield 10, "II", [("assistant", ""), ("user", "")]

    def edits(i):
        _, role, text = rows[i]
        yield 2, "D", []
        if fault[i] in ("blank", "duplicate"):
            return
        more = 5 if fault[i] == "truncated" else 0
        yield more, "K", [(role, text)]
        for to in ("user", "assistant"):
            yield more + 1, "R", [(to, text)]

    steps = [x for i in range(len(rows)) for x in (gaps(i), edits(i))] + [gaps(len(rows))]
    for choice in itertools.product(*[list(s) for s in steps]):
        got = [r for c in choice for r in c[2]]
        initials = "".join(r[0][:1] or "-" for r in got)
        body = initials[1:] if initials.startswith("s") else initials
        if initials and (not body or body != "ua" * (len(body) // 2)):
            continue
        yield sum(c[0] for c in choice), "".join(c[1] for c in choice), got


def dp(rows, fault):
    """The cheapest, ASCII-least audit by a plain DP over whole strings."""
    states = {"": (0, "", ())}

    def put(to, s, new):
        to[s] = min(to.get(s, new), new)

    def insert(states):
        for _ in range(3):
            for s, (cost, audit, got) in list(states.items()):
                due = ("assistant", "a") if s == "u" else ("user", "u")
                put(states, due[1], (cost + 5, audit + "I", got + ((due[0], ""),)))

    insert(states)
    for (_, role, text), f in zip(rows, fault, strict=True):
        new = {}
        for s, (cost, audit, got) in states.items():
            put(new, s, (cost + 2, audit + "D", got))
            if f in ("blank", "duplicate"):
                continue
            more = 5 if f == "truncated" else 0
            due = ("assistant", "a") if s == "u" else ("user", "u")
            put(new, due[1], (cost + more, audit + "K", got + ((role, text),)) if role[:1] == due[1]
                else (cost + more + 1, audit + "R", got + ((due[0], text),)))
            if s == "" and role[:1] == "s":
                put(new, "s", (cost + more, audit + "K", got + ((role, text),)))
        states = new
        insert(states)
    return min(states[s] for s in ("", "a") if s in states)


def expected(rows, repair=dp):
    out = []
    for conv, kept in break_rows(rows).items():
        fault = faults(kept)
        cost, audit, got = repair(kept, fault) if kept else (0, "", ())
        turns = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for _, r, _ in kept]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *[fault.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in got).encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows],
                               "conv_id long, turn long, role string, text string, audit string, copies int")
    return df.repartition(parts)


def run(spark, rows, parts=3):
    df = table(spark, rows, parts)
    return sorted(map(tuple, cr.reports(cr.damaged(df), df, "copies").collect()), key=repr)


def talk(seed, conversations, length):
    r = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(r.randrange(1, length)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "umbrella", None])
            text = r.choice(["Yes.", "No!", "Why", " ", "", None, "a b\n", "So? \t", "É.", " ", "x" * r.randrange(9) + "."])
            rows.append((conv, r.choice([turn, turn, turn * 2, None]), role, text))
    return rows


def test_plain_dp_against_all_repairs():
    r = random.Random(3)
    for _ in range(40):
        rows = [(i, r.choice(["user", "assistant", "system", "tool"]), r.choice(["A.", "B", "C.", ""])) for i in range(r.randrange(4))]
        fault = faults(rows)
        cost, audit, got = min((c, a, tuple(g)) for c, a, g in all_repairs(rows, fault))
        assert (cost, audit, got) == dp(rows, fault)


def test_against_brute_force(spark):
    rows = talk(0, 300, 12)
    assert run(spark, rows) == expected(rows)


def test_one_conversation_over_many_pieces(spark, monkeypatch):
    rows = [(5, t, role, f"{role} {t % 97}{'.' if t % 5 else ''}") for t in range(900)
            for role in [["user", "assistant", "user", "system"][t * 7 % 4]]] + talk(1, 5, 6)
    want = expected(rows)
    monkeypatch.setattr(cr, "PIECE_ROWS", 50)
    assert run(spark, rows, 8) == want
    monkeypatch.setattr(cr, "PIECE_ROWS", 1)
    assert run(spark, rows, 2) == want


def test_edges(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, 3, "user", "Hm."), (1, 4, "user", "word " * 300000 + "."),
            (1, 4, "user", "word " * 300000 + "."), (1, 9, "assistant", " " * 200000), (2, -5, "system", "Be kind."),
            (3, 1, "assistant", "x\u0000."), (9, 2, "\U0001f916", "\U0001f916")]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    assert run(spark, [(dropped, 1, "user", "Hi.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    got = cr.reports(table(spark, rows))
    assert got.dtypes == [(x.split()[0], x.split()[1]) for x in cr.REPORT.split(", ")]


def test_repaired_rows(spark):
    rows = talk(2, 60, 9)
    got = {}
    for r in cr.repaired(cr.damaged(table(spark, rows)), "copies").orderBy("conv_id", "position").collect():
        assert r.position == len(got.setdefault(r.conv_id, []))
        got[r.conv_id].append(f"{r.role}:{r.text}")
    hashes = {e[0]: e[-1] for e in expected(rows)}
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in got.items()} == \
        {c: h for c, h in hashes.items() if h != empty}


@pytest.mark.parametrize("mod", [cr.MOD, 3, 1])
def test_audits_compare_as_strings(mod):
    """A modulus of 1 makes every hash collide: comparison must not trust it."""
    r = random.Random(mod)
    audits = cr.Audits(mod=mod)
    nodes = [0]
    for _ in range(400):
        nodes.append(audits.add(r.choice(nodes[-30:]), r.choice("DK" if r.random() < 0.7 else "IR")))
    for _ in range(4000):
        a, b = r.choice(nodes), r.choice(nodes)
        assert audits.less(a, b) == (audits.text(a) < audits.text(b))


def test_linked_prefixes_stay_small():
    audits = cr.Audits()
    node = 0
    for _ in range(5000):
        node = audits.add(node, "K")
    assert len(audits.up[node]) <= 14 and audits.text(audits.ancestor(node, 17)) == "K" * 17


def test_a_hot_text_is_one_row_with_a_count(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi.")] * 500 + [(1, 2, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
    r = cr.reports(df).first()
    assert (r.duplicate, r.cost, r.audit) == (499, 998, "K" + "D" * 499 + "K")
