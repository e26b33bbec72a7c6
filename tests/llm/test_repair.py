import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

from tests.llm.conftest import SMALL
from tillwork.llm import repair

ROWS = "conv_id long, turn long, role string, text string, kind string, at int"


def brute_damage(rows):
    out = []
    for c, t, r, x in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        out += [(c, t, "user" if fate == 4 else r, x)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def brute_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                      else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def brute_edits(roles, faults):
    """Cheapest (cost, audit, roles) over all edits, by recursion from the front over the roles given so far."""
    def grows(made):
        return re.fullmatch("(s?(ua)*u?)?|s", made)

    @lru_cache(None)
    def best(i, last, fresh):
        """From row i on; ``last`` is the last role's initial, ``fresh`` the insertions just made."""
        found = []
        if i == len(roles) and last in ("", "a"):
            found.append((0, "", ()))

        def add(cost, letter, role, step, more):
            if role is None or grows({"": "", "s": "s", "u": "u", "a": "ua"}[last] + role):
                rest = best(i + step, last if role is None else role, more)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], ((letter, role),) + rest[2]))

        if fresh < 3:
            for role in "ua":
                add(5, "I", role, 0, fresh + 1)
        if i < len(roles):
            add(2, "D", None, 1, 0)
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if roles[i] in ("s", "u", "a"):
                    add(extra, "K", roles[i], 1, 0)
                for role in "ua":
                    add(1 + extra, "R", role, 1, 0)
        return min(found, key=lambda f: f[:2]) if found else None

    return best(0, "", 0)


def brute(rows, names):
    out = []
    for conv in names:
        own = sorted((r for r in rows if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, roles = brute_faults(own), [r[2][:1] for r in own]
        cost, audit, edits = brute_edits(tuple(roles), tuple(faults))
        lines, left = [], iter(own)
        for letter, role in edits:
            row = next(left) if letter != "I" else None
            name = {"u": "user", "a": "assistant", "s": "system"}.get(role)
            if letter != "D":
                lines.append(f"{row[2] if letter == 'K' else name}:{row[3] if row else ''}")
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [a + b for a, b in zip(roles, roles[1:])]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(rows, names=None, **args):
    return sorted(map(tuple, repair.repair(rows, names, **args).collect()), key=str)


def clean(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


def test_trace_against_all_edits():
    """All conversations of up to four rows over every role and fault, from a speculative start in each chunk size."""
    known = repair.Costs()
    names = ["", "s", "u", "a"]
    kinds = ["", "truncated", "duplicate", "blank"]
    random.seed(3)
    cases = [c for n in range(4) for c in itertools.product(range(16), repeat=n)]
    cases += [tuple(random.choices(range(16), k=random.randint(4, 12))) for _ in range(600)]
    for symbols in cases:
        roles = tuple(names[s % 4] or "x" for s in symbols)
        cost, audit, _ = brute_edits(roles, tuple(kinds[s // 4] for s in symbols))
        edits, state = repair.trace(known, bytes(symbols), repair.AT_END, repair.START)
        letters = "".join(e for row in edits for e, _ in row) + "I" * {2: 1, 1: 2}.get(state, 0)
        front, gained = repair.first_pass(known, bytes(symbols), repair.AT_END)
        assert (front[0] + gained, letters) == (cost, audit), symbols


def test_fix_up_equals_a_pass_from_the_right_start():
    known, vectors = repair.Costs(), [repair.AT_END, repair.SPECULATIVE, (3, 0, 5, 1), (0, 9, 2, 2)]
    random.seed(4)
    for _ in range(300):
        symbols = bytes(random.choices(range(16), k=random.randint(0, 30)))
        a, b = random.sample(vectors, 2)
        first = repair.first_pass(known, symbols, a)
        assert repair.fix_up(known, symbols, a, b, *first) == repair.first_pass(known, symbols, b)


def test_conversations(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    expected = brute(brute_damage(rows), sorted({r[0] for r in rows}))
    assert found(repair.damaged(given), given.select("conv_id")) == expected


def test_long_conversations_in_small_chunks(spark):
    random.seed(7)
    rows = []
    for conv, n in ((1, 60), (2, 90), (None, 40), (4, 1)):
        for i in range(n):
            role = random.choice(["user", "assistant", "assistant", "system", "tool", None, ""])
            text = random.choice(["Yes.", "No", "", " \t", None, f"Text {i}!", f"Text {i}", f"What {i % 9}?"])
            rows.append((conv, random.choice([i, i, i + 3, None]), role, text))
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], ROWS)
    expected = brute(clean(rows), [1, 2, None, 4])
    for chunk in (1, 7):
        assert found(df, chunk=chunk) == expected


def test_odd_rows(spark):
    rows = [(1, 0, "user", "Hi." * 50000), (1, 1, "assistant", "Ho\x1c."), (2, None, None, None),
            (3, 0, "user", "One.\n\t"), (3, 0, "user", "One.\n\t"), (3, 0, "assistant", "퟿ é 日本."),
            (4, 5, "assistant", "x\u0000."), (4, 9, "user", "Last?")]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], ROWS)
    assert found(df) == brute(clean(rows), [1, 2, 3, 4])
    assert found(repair.damaged(df), df.select("conv_id")) == brute(brute_damage(rows), [1, 2, 3, 4])


def test_names_without_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    names = spark.createDataFrame([(8,), (8,), (None,)], "conv_id long")
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(empty, names) == sorted([(8, *[0] * 6, "", nothing), (None, *[0] * 6, "", nothing)], key=str)
    assert found(empty) == []


def test_costs_of_one_long_conversation(spark):
    """Speculation is put right across many chunks and the edits still give the pattern."""
    rows = spark.range(3000).selectExpr(
        "1L as conv_id", "id as turn", "element_at(array('assistant','user','user','tool'), int(pmod(hash(id), 4)) + 1) as role",
        "concat('t', id, if(pmod(hash(id, 1), 5) = 0, '', '.')) as text")
    (row,) = repair.repair(rows, chunk=16).collect()
    (whole,) = repair.repair(rows, chunk=100_000).collect()
    assert row == whole and row.cost > 0 and sum(row.audit.count(c) for c in "DKR") == 3000
