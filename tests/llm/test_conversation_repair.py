"""Conversation repair against every possible list of edits, and against a plain search row by row."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

pytest.importorskip("millrace.llm")

from millrace.llm import conversation_repair as repair  # noqa: E402
from millrace.llm.common import Workspace, read  # noqa: E402
from millrace.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()
KEYS = ["blank", "duplicate", "truncated"]


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        if not marks:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("ok" if marks[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def wanted(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def by_enumeration(rows):
    """Cheapest edits among all with at most two inserts in a place: cost, audit and repaired rows."""
    best = None
    for inserts in product(range(3), repeat=len(rows) + 1):
        for edits in product("DKua", repeat=len(rows)):
            cost, audit, out = 5 * sum(inserts), "", []
            holes = []
            for k, ((role, text), fault, edit) in enumerate(zip(rows, faults_of(rows), edits)):
                audit += "I" * inserts[k]
                holes += [len(out) + n for n in range(inserts[k])]
                out += [None] * inserts[k]
                if edit == "D":
                    cost += 2
                elif fault in ("blank", "duplicate"):
                    break
                else:
                    cost += (edit != "K") + 5 * (fault == "truncated")
                    out.append((role if edit == "K" else {"u": "user", "a": "assistant"}[edit], text))
                audit += edit if edit in "DK" else "R"
            else:
                audit += "I" * inserts[-1]
                out += [None] * inserts[-1]
                if best and (cost, audit) >= best[:2]:
                    continue
                for names in product(("user", "assistant"), repeat=sum(inserts)):
                    filled, left = [], iter(names)
                    for row in out:
                        filled.append(row or (next(left), ""))
                    if wanted("".join(role[:1] for role, _ in filled)) and all(role for role, _ in filled):
                        best = cost, audit, filled
                        break
    return best


def by_rows(rows):
    """The same by dynamic programming over single rows, with whole strings."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def offer(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def with_inserts(table):
        out = {}
        for state, (cost, audit, kept) in table.items():
            for n in range(3):
                offer(out, state, (cost + 5 * n, audit + "I" * n, kept))
                kept, state = kept + ((names[after[state]], ""),), after[state]
        return out

    table = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults_of(rows)):
        new, extra = {}, 5 * (fault == "truncated")
        for state, (cost, audit, kept) in with_inserts(table).items():
            offer(new, state, (cost + 2, audit + "D", kept))
            if fault in ("ok", "truncated"):
                to = after[state]
                offer(new, to, (cost + 1 + extra, audit + "R", kept + ((names[to], text),)))
                if role[:1] and (role[:1] == to or (role[:1] == "s" and state == "")):
                    offer(new, role[:1], (cost + extra, audit + "K", kept + ((role, text),)))
        table = new
    return min(value for state, value in with_inserts(table).items() if state in ("", "a"))


def figures(turns, rows):
    """Every column of the report but the id."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", EMPTY)
    faults = faults_of(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    legal = {("s", "u"), ("u", "a"), ("a", "u")}
    illegal = sum((a[0][:1], b[0][:1]) not in legal for a, b in zip(rows, rows[1:]))
    cost, audit, kept = by_rows(rows)
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
    return (gaps, *(faults.count(k) for k in KEYS), illegal, cost, audit, digest)


def damaged(rows):
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        how = zlib.crc32(key.encode()) % 20
        if how == 1:
            text = ""
        if how == 2:
            text = re.sub("[.!?]", "", text)
        if how == 4:
            role = "user"
        yield from [(conv_id, turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)


def report_of(rows, ids):
    out = []
    for one in ids:
        mine = sorted((r[1:] for r in rows if r[0] == one), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        out.append((one, *figures([r[0] for r in mine], [tuple(r[1:]) for r in mine])))
    return sorted(out, key=repr)


def plain_rows(df):
    return sorted(((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()), key=repr)


def some_rows(rng, size):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    texts = ["Yes.", "No!", "cut", "  ", "Why? ", "é.\n", "Well. but"]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{k}.") for k in range(size)]


def test_plain_search_equals_enumeration():
    rng = random.Random(4)
    for _ in range(40):
        rows = some_rows(rng, rng.randint(0, 3))
        assert by_rows(rows) == tuple(tuple(x) if isinstance(x, list) else x for x in by_enumeration(rows)), rows


def symbol(role, fault):
    return repair.SYMBOLS[4 * ("sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3) + ["ok", "truncated", "blank", "duplicate"].index(fault)]


def test_rules_equal_the_plain_search_with_any_grammar():
    rng = random.Random(9)
    for _ in range(150):
        rows = some_rows(rng, rng.randint(1, 60))
        symbols = "".join(symbol(role, fault) for (role, _), fault in zip(rows, faults_of(rows)))
        pairs: tuple = ()
        for _ in range(rng.randint(0, 30)):
            now = repair.compressed(symbols, pairs)
            if len(now) < 2:
                break
            at = rng.randrange(len(now) - 1)
            pairs += (now[at : at + 2],)
        cut = sorted({0, len(symbols), *(rng.randrange(len(symbols)) for _ in range(3))})
        paths = repair._Paths()
        for segment, (a, b) in enumerate(zip(cut, cut[1:])):
            for one in repair.compressed(symbols[a:b], pairs):
                paths.extend(repair.grammar_rules(pairs)[one], segment)
        cost, parts = paths.finish()
        audit = "".join(edits for _, _, edits in parts)
        assert (cost, audit) == by_rows(rows)[:2] and len(audit) - audit.count("I") == len(rows)
        assert [len(e) - e.count("I") for _, _, e in parts] == [b - a for a, b in zip(cut, cut[1:])]


def test_report_of_unusual_conversations(spark):
    rng = random.Random(6)
    rows = [(c, t, *r) for c in range(12) for t, r in enumerate(some_rows(rng, rng.randint(1, 9)))]
    rows += [(None, t, *r) for t, r in enumerate(some_rows(rng, 6))] + [(20, None, "user", "Hm."), (20, None, None, None), (20, 3, "assistant", "So.")]
    rows += [(21, 1, "user", "x " * 100_000 + "."), (21, 2, "assistant", None), (21, 9, "assistant", "y."), (21, 9, "assistant", "y.")]
    rows += [(22, None, "user", "Only.")] + [(23, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant"), f"{t}.") for t in range(900)]
    conversations = spark.createDataFrame([(*r, "clash") for r in rows], "CONV_id long, Turn long, role string, text string, segment string")
    with Workspace(spark, "test") as work:
        got = plain_rows(repair.repair_report(conversations, repair.with_damage(conversations), work))
        assert got == report_of(list(damaged(rows)), sorted({r[0] for r in rows}, key=repr))
    with Workspace(spark, "test") as work:
        assert repair.repair_report(conversations.limit(0), repair.with_damage(conversations.limit(0)), work).collect() == []


def test_long_conversation_over_many_segments_and_tasks(spark, monkeypatch, request):
    monkeypatch.setattr(repair, "SEGMENT_BITS", 3)
    monkeypatch.setattr(repair, "PLACES", 32)
    rng = random.Random(2)
    rows = [(1, t, *r) for t, r in enumerate(some_rows(rng, 3000))] + [(c, t, *r) for c in (0, 2) for t, r in enumerate(some_rows(rng, 40))]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    with Workspace(spark, "test") as work:
        found = repair.Repair(conversations, work)
        assert found.rows.filter("conv_id = 1").select((repair.F.shiftright("place", 33)).alias("p")).distinct().count() > 3
        edited = sorted((tuple(r) for r in found.repaired().collect()), key=lambda r: r[:2])
        assert edited == sorted((tuple(r) for r in found.repaired(together=True).collect()), key=lambda r: r[:2])
        for one in (0, 1, 2):
            expected = by_rows([r[2:] for r in rows if r[0] == one])
            assert [tuple(r[2:4]) for r in edited if r[0] == one] == list(expected[2])
            [row] = found.conversations().filter(f"conv_id = {one}").collect()
            assert (row.cost, row.audit) == expected[:2]


def test_query_equals_the_plain_search(spark):
    rows = [tuple(r) for r in read(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert plain_rows(QUERIES["op13_conversation_repair"](spark, SF)) == report_of(list(damaged(rows)), {r[0] for r in rows})
