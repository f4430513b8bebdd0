import hashlib
import itertools
import random
import re
import zlib

import pytest
from tidewatch.llm import registry
from tidewatch.llm.conversation_repair import damaged, fates, lightest, repair

EMPTY = hashlib.sha256().hexdigest()
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def by_hand(lines):
    """Brute force: all edit sequences in order of cost and audit, tried on the pattern."""
    lines = sorted(lines, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    seen, faults = set(), []
    for _, role, text in lines:
        solid = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                      else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in lines]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    turns = [t for t, _, _ in lines if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    best = None
    row_edits = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for f in faults]
    places = len(lines) + 1
    for edits in itertools.product(*row_edits):
        base = sum({"K": 0, "R": 2, "D": 3}[e[0]] + (f == "truncated" and e != "D") for e, f in zip(edits, faults))
        for inserted in itertools.product(["", "u", "a", "ua", "au"], repeat=places):
            cost = base + 2 * sum(map(len, inserted))
            if best and cost > best[0]:
                continue
            roles = text = audit = ""
            out = []
            for k in range(places):
                # inserts may also stand behind a deleted row; the audit says where, the text does not
                for c in inserted[k]:
                    out.append((ROLE[c], ""))
                    audit += "I"
                if k < len(lines):
                    audit += edits[k][0]
                    if edits[k] != "D":
                        role = lines[k][1] if edits[k] == "K" else ROLE[edits[k][1]]
                        out.append((role, lines[k][2]))
            roles = "".join(r[:1] or "?" for r, _ in out)
            if re.fullmatch("(s?(ua)+)?", roles) and (not best or (cost, audit) < best[:2]):
                text = "\n".join(f"{r}:{t}" for r, t in out)
                best = cost, audit, hashlib.sha256(text.encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *best


def expected(rows):
    held = {conv: [] for conv, *_ in rows}
    for conv, *line in damage(rows):
        held[conv].append(tuple(line))
    return {conv: by_hand(lines) for conv, lines in held.items()}


def found(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in frame.collect()}


SCHEMA = "conv_id long, turn long, role string, text string, lines string, n int, own string, fault string, `at` long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x", "x", 1) for r in rows], SCHEMA)


def some_rows(seed, convs=40, most=3):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "Open", "", " \t", None, "Tail. ", "a:b\nc.", "Ü漢."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "using"]
    rows = []
    for conv in range(convs):
        turn = 0
        for _ in range(rng.randint(0, most)):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((rng.choice([conv, conv, conv, None]) if conv == 3 else conv,
                         None if rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("group_rows", [1000, 1])
def test_repairs_equal_brute_force(spark, group_rows):
    rows = [r for r in some_rows(4) if r[0] is not None] + [(None, 5, "user", "Hi."), (None, None, "assistant", "Hm")]
    got = found(repair(damaged(table(spark, rows)), group_rows=group_rows))
    assert got == expected(rows)


def test_whole_query_against_a_plain_program(spark, sf_dir):
    """The query on its table; costs and audits by a table over positions and states instead of an agenda."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = found(registry.op13_conversation_repair(spark, sf_dir))
    held = {conv: [] for conv, *_ in rows}
    for conv, *line in damage(rows):
        held[conv].append(tuple(line))
    assert got.keys() == held.keys()
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    for conv, lines in held.items():
        lines.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen = set()
        best = {0: (0, "", ())}
        def inserted(best):
            for _ in range(4):
                for q, (c, a, t) in list(best.items()):
                    for r in "ua":
                        if (q, r) in step:
                            new = (c + 2, a + "I", t + (f"{ROLE[r]}:",))
                            best[step[q, r]] = min(best.get(step[q, r], new), new)
            return best
        best = inserted(best)
        for _, role, text in lines:
            solid = text.strip(" \t\n\v\f\r")
            bad = not solid or (role, text) in seen
            seen.add((role, text))
            more = bool(solid) and solid[-1] not in ".!?"
            then = {}
            for q, (c, a, t) in best.items():
                moves = [(q, (c + 3, a + "D", t))]
                if not bad:
                    if (q, role[:1]) in step:
                        moves.append((step[q, role[:1]], (c + more, a + "K", t + (f"{role}:{text}",))))
                    moves += [(step[q, r], (c + 2 + more, a + "R", t + (f"{ROLE[r]}:{text}",))) for r in "ua" if (q, r) in step]
                for to, new in moves:
                    then[to] = min(then.get(to, new), new)
            best = inserted(then)
        cost, audit, text = min(best[q] for q in (0, 3) if q in best)
        assert got[conv][5:] == (cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()), conv


def test_long_conversations_take_the_same_way(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "user", "assistant", "system"]),
             rng.choice(["Yes.", "No!", "Maybe", "", f"Turn {t}.", f"Turn {t}."])) for t in range(3000)]
    rows += [(1, 7, "user", "The same.")] * 1500 + [(None, t, "user", f"{t}.") for t in range(40)] + [(2, 1, "user", "Hi.")]
    whole = found(repair(damaged(table(spark, rows)), group_rows=10_000))
    parts = found(repair(damaged(table(spark, rows).repartition(7)), group_rows=30))
    assert whole == parts
    letters = {}
    for conv in (1, None, 2):
        assert len(whole[conv][6].replace("I", "")) == len([r for r in damage(rows) if r[0] == conv]), letters


def test_odd_and_empty_tables(spark):
    assert repair(damaged(table(spark, []))).count() == 0
    rows = [(c, 0, "user", "x" * 200_000) for c in range(30)]
    got = found(repair(damaged(table(spark, rows)), group_bytes=1))
    assert got == expected(rows)
    dropped = [c for c in range(30) if not damage([r for r in rows if r[0] == c])]
    assert dropped and all(got[c] == (0, 0, 0, 0, 0, 0, "", EMPTY) for c in dropped)


def test_ties_take_the_ascii_least_audit():
    assert lightest("") == (0, "")
    assert lightest("ua") == (0, "KK")
    assert lightest("uu") == (2, "KR")
    assert lightest("u") == (2, "KI")
    assert lightest("x") == (3, "D")
    assert fates(["u", "D"], 0, "KDI") == ["K", "a"]
