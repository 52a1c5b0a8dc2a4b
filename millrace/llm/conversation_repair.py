"""Repair of conversations whose turns should go ``(system)? (user assistant)+``, by the cheapest edits.

Every row becomes one symbol: the class of its role and its first fault. Conversations are cut into segments of bounded
length, and pairs of neighbouring symbols that are frequent in all segments become rules of a grammar, round by round
(Re-Pair). A rule has a min-plus matrix over the four states of the wanted order: the cost of going from one state to
another through its rows, and the edits as a rope that shares those of its two parts. Matrices are made from those of
the parts, bottom-up, once a process; a conversation is then a short product of matrices that all conversations share.

A conversation of any length is spread over tasks by ranges of its turns; its segments meet again as a few symbols each,
in a stream that holds four paths. Texts move once to be sorted and once to be put together.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, pick, ship

SPACE = " \t\n\v\f\r"
SEGMENT_BITS = 12  # a segment has at most 4096 rows
PLACES = 4 << SEGMENT_BITS  # numbers for the repaired rows of a segment: each row and two inserted before it
ROUNDS, RULES_A_ROUND = 8, 48  # the grammar's size; what it does not cover is evaluated symbol by symbol
GAIN = 0.98  # a round that leaves more of the symbols than this is the last one
PATIENCE = 1 << 19  # characters handed on at once

OK, TRUNCATED, BLANK, DUPLICATE = range(4)
ROLES = "sua"  # initials of the roles in a symbol; any other role comes after them
SYMBOLS = "ABCDEFGHIJKLMNOP"  # symbol of 4 * role + fault
FIRST_RULE = 0x100  # rules are characters from here on
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows end with
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what an inserted or renamed row becomes
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
KEEP, RENAME, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

ship(__name__)


class Rope:
    """Edits that share their parts; written out when they are asked for, once."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, left: Rope | None, right: Rope | None, text: str | None = None):
        self.left, self.right, self._text = left, right, text

    @property
    def text(self) -> str:
        if self._text is None:
            parts, waiting = [], [self]
            while waiting:
                rope = waiting.pop()
                if rope._text is None:
                    waiting += [rope.right, rope.left]
                else:
                    parts.append(rope._text)
            self._text = "".join(parts)
        return self._text


class Rule:
    """Consecutive rows: the cheapest edits between two states, how many faults, and the initials at the ends."""

    __slots__ = ("paths", "faults", "first", "last")

    def __init__(self, paths: dict[tuple[int, int], tuple[int, Rope]], faults: tuple[int, ...], first: str, last: str):
        self.paths, self.faults, self.first, self.last = paths, faults, first, last


def _cheapest(options: list[tuple[int, int, int, Rope]]) -> dict[tuple[int, int], tuple[int, Rope]]:
    """Of ``(from, to, cost, edits)`` the cheapest for each two states, of these the least edits in ASCII order.

    Equally cheap edits of the same rows between the same states are never one the beginning of the other (it would
    go on with inserts, at a cost), so what is least stays least whatever comes before or after.
    """
    best: dict[tuple[int, int], tuple[int, Rope]] = {}
    for i, j, cost, rope in options:
        known = best.get((i, j))
        if known is None or cost < known[0] or (cost == known[0] and rope.text < known[1].text):
            best[i, j] = cost, rope
    return best


def _row(symbol: str) -> Rule:
    """The rule of one row: any inserts before it, then its own edit."""
    role, fault = divmod(SYMBOLS.index(symbol), 4)
    initial = ROLES[role : role + 1] or "?"
    edits = [(i, i, DELETE, "D") for i in range(4)]
    if fault in (OK, TRUNCATED):
        extra = CUT_OFF if fault == TRUNCATED else 0
        edits += [(i, j, RENAME + extra, "R") for i, j in NEXT.items()]
        kept = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
        edits += [(i, j, KEEP + extra, "K") for i, j in kept.get(initial, [])]
    options = []
    for before in range(4):
        state = before
        for inserts in range(3):
            options += [
                (before, j, INSERT * inserts + cost, Rope(None, None, "I" * inserts + edit))
                for i, j, cost, edit in edits
                if i == state
            ]
            state = NEXT[state]
    faults = (fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, False)
    return Rule(_cheapest(options), tuple(map(int, faults)), initial, initial)


def _joined(a: Rule, b: Rule) -> Rule:
    """The min-plus product of two rules that follow each other."""
    options = [
        (i, j, cost + more, Rope(rope, rest))
        for (i, k), (cost, rope) in a.paths.items()
        for (start, j), (more, rest) in b.paths.items()
        if start == k
    ]
    faults = [x + y for x, y in zip(a.faults, b.faults)]
    faults[3] += (a.last, b.first) not in LEGAL
    return Rule(_cheapest(options), tuple(faults), a.first, b.last)


_rules: dict[str, Rule] = {}
_known: list[tuple[str, ...]] = []


def grammar_rules(pairs: tuple[str, ...]) -> dict[str, Rule]:
    """The rule of every symbol, bottom-up, made once a process."""
    if _known != [pairs]:
        _known[:] = [pairs]
        _rules.clear()
        _rules.update({symbol: _row(symbol) for symbol in SYMBOLS})
        for k, pair in enumerate(pairs):
            _rules[chr(FIRST_RULE + k)] = _joined(_rules[pair[0]], _rules[pair[1]])
    return _rules


def compressed(symbols: str, pairs: tuple[str, ...], first: int = 0) -> str:
    """Symbols with the grammar's pairs replaced by their rules, one rule after the other."""
    for k in range(first, len(pairs)):
        symbols = symbols.replace(pairs[k], chr(FIRST_RULE + k))
    return symbols


def learn_pairs(equal: DataFrame, rounds: int = ROUNDS, rules: int = RULES_A_ROUND) -> tuple[str, ...]:
    """The grammar of all segments, given as ``symbols`` and how often (``n``): in every round the most frequent pairs
    of neighbours, counted over all of them."""
    pairs: tuple[str, ...] = ()
    before = None
    for _ in range(rounds):

        def count(batches: Iterator[pa.RecordBatch], pairs: tuple[str, ...] = pairs) -> Iterator[pa.RecordBatch]:
            total: Counter[str] = Counter()
            for batch in batches:
                for symbols, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist()):
                    symbols = compressed(symbols, pairs)
                    total[""] += n * len(symbols)
                    last = None
                    for pair in map(str.__add__, symbols, symbols[1:]):
                        last = None if pair == last and pair[0] == pair[1] else pair  # three alike are one pair
                        total[pair] += n * (last is not None)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["pair", "n"])

        counts = equal.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        found = counts.filter("n > 1").orderBy(F.length("pair"), F.desc("n"), "pair").limit(rules + 1).collect()
        size = found[0]["n"] if found and found[0]["pair"] == "" else 0
        new = tuple(row["pair"] for row in found if row["pair"])
        if not new or (before is not None and size > GAIN * before):
            break
        pairs, before = pairs + new, size
    return pairs


class _Paths:
    """The cheapest path to each state through the rows so far.

    ``ends`` has cost and last step of each path; a step is ``(step before, segment, state before, edits)``. ``apart``
    tells how two paths' edits compare: which is less, or what each has beyond the other (inserts only).
    """

    def __init__(self) -> None:
        self.ends: dict[int, tuple[int, tuple | None]] = {START: (0, None)}
        self.apart: dict[tuple[int, int], int | tuple[str, str]] = {}
        self.faults, self.last = (0, 0, 0, 0), ""

    def _compare(self, i: int, x: str, j: int, y: str) -> int | tuple[str, str]:
        """Path i with x against path j with y: -1 or 1, or their rests where one begins the other."""
        if i != j:
            known = self.apart[i, j] if i < j else self.apart[j, i]
            if isinstance(known, int):
                return known if i < j else -known
            a, b = known if i < j else known[::-1]
            x, y = a + x, b + y
        if x.startswith(y) or y.startswith(x):
            return x[len(y) :], y[len(x) :]
        return -1 if x < y else 1

    def extend(self, rule: Rule, segment: int) -> None:
        best: dict[int, tuple[int, int, Rope]] = {}
        for (i, j), (more, rope) in rule.paths.items():
            if i in self.ends:
                cost = self.ends[i][0] + more
                known = best.get(j)
                if known is None or cost < known[0] or (
                    cost == known[0] and self._compare(i, rope.text, known[1], known[2].text) == -1
                ):
                    best[j] = cost, i, rope
        states = sorted(best)
        self.apart = {
            (j, k): self._compare(best[j][1], best[j][2].text, best[k][1], best[k][2].text)
            for n, j in enumerate(states)
            for k in states[n + 1 :]
        }
        self.ends = {j: (cost, (self.ends[i][1], segment, i, rope)) for j, (cost, i, rope) in best.items()}
        faults = [x + y for x, y in zip(self.faults, rule.faults)]
        faults[3] += bool(self.last) and (self.last, rule.first) not in LEGAL
        self.faults, self.last = tuple(faults), rule.last

    def finish(self) -> tuple[int, list[tuple[int, int, str]]]:
        """The cost of the whole, and segment, state before it and edits of each segment, in order."""
        tails = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        best = None
        for state, (cost, _) in self.ends.items():
            cost += INSERT * len(tails[state])
            if best is None or cost < best[0] or (
                cost == best[0] and self._compare(state, tails[state], best[1], tails[best[1]]) == -1
            ):
                best = cost, state
        cost, state = best
        parts: list[tuple[int, int, list[Rope]]] = []
        step = self.ends[state][1]
        while step is not None:
            step, segment, before, rope = step
            if not parts or parts[-1][0] != segment:
                parts.append((segment, before, []))
            parts[-1] = segment, before, parts[-1][2]  # the state before the segment's first step
            parts[-1][2].append(rope)
        out = [(segment, before, "".join(rope.text for rope in reversed(ropes))) for segment, before, ropes in reversed(parts)]
        out[-1] = (*out[-1][:2], out[-1][2] + tails[state])
        return cost, out


PLAN = "conv_id long, segment long, state int, edits string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PLAN = pa.schema(
    [("conv_id", pa.int64()), ("segment", pa.int64()), ("state", pa.int32()), ("edits", pa.string())]
    + [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)


def _plans(segments: DataFrame, pairs: tuple[str, ...]) -> DataFrame:
    """One row per segment with its edits; the last one of a conversation has the conversation's figures too."""

    def rows(conv_id: int | None, paths: _Paths) -> Iterator[tuple]:
        cost, parts = paths.finish()
        audit = "".join(edits for _, _, edits in parts)
        for k, (segment, state, edits) in enumerate(parts):
            figures = (*paths.faults, cost, audit) if k + 1 == len(parts) else (None,) * 6
            yield conv_id, segment, state, edits, *figures

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = grammar_rules(pairs)
        current, paths, waiting, size = None, None, [], 0

        def batch_of() -> pa.RecordBatch:
            columns = zip(*waiting)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _PLAN)], schema=_PLAN)

        for batch in batches:
            for conv_id, segment, symbols in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "symbols"))):
                if paths is None or conv_id != current:
                    if paths is not None:
                        waiting += rows(current, paths)
                    current, paths = conv_id, _Paths()
                for symbol in compressed(symbols, pairs):
                    paths.extend(rules[symbol], segment)
                size += len(symbols)
                if size > PATIENCE and waiting:
                    yield batch_of()
                    waiting, size = [], 0
        if paths is not None:
            waiting += rows(current, paths)
        if waiting:
            yield batch_of()

    ordered = segments.select("conv_id", "segment", "symbols").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(plan, PLAN)


def _any_of(names: list[str], value: Column) -> Column:
    """Position of a value among names; their number if it is none of them."""
    return reduce(lambda rest, k: F.when(value == names[k], k).otherwise(rest), reversed(range(len(names))), F.lit(len(names)))


class Repair:
    """Conversations repaired in ``work``'s folder; every method returns rows that live as long as that folder.

    ``rows`` has one row per turn; the columns may have any names and letter case, others are ignored. A null role or
    text is one space. A conversation's rows go by turn (null first), then role, text (its first 256 characters, then
    its digest); a null ``conv_id`` is a conversation like any other. The first fault of a row counts: ``blank`` (no
    ``[^\\x20\\x09-\\x0D]``), ``duplicate`` (its role and text came before in the conversation), ``truncated`` (its last
    such character is not one of ``.!?``). Keeping a row costs 0, giving it the role user or assistant 1, deleting it 2
    (blank and duplicate rows must go), an inserted empty user or assistant row 5; a truncated row that stays adds 5.
    Of equally cheap edits the least as text are taken. An empty table gives empty results.
    """

    def __init__(
        self, rows: DataFrame, work: Workspace, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
    ):
        plain = pick(rows, conv_id=conv_id, turn=turn, role=role, text=text).select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        )
        key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.length("role").cast("string"), F.lit(":"))
        same = F.unhex(F.md5(F.concat(key, F.col("role"), F.col("text")).cast("binary")))
        placed = plain.withColumns({"same": same, "begin": F.substring("text", 1, 256), "row": F.monotonically_increasing_id()})
        order = ["conv_id", "turn", "role", "begin", "same", "row"]  # "row" only parts equal rows
        placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("begin", "row")
        self.rows = work.keep(placed.withColumn("place", F.monotonically_increasing_id()))
        self.segments = work.keep(self._symbols())
        self.pairs = learn_pairs(work.keep(self.segments.groupBy("symbols").agg(F.count(F.lit(1)).alias("n"))))
        self.plans = work.keep(_plans(self.segments, self.pairs))

    def _symbols(self) -> DataFrame:
        """Segments: consecutive rows of one conversation as a text of symbols."""
        repeated = self.rows.groupBy("same").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        end = F.rtrim(F.col("text"), F.lit(SPACE))
        local = F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(*".!?"), OK).otherwise(TRUNCATED)
        role = _any_of(list(ROLES), F.substring("role", 1, 1))
        small = self.rows.select("conv_id", "place", "same", role.alias("role"), local.alias("local"))
        fault = F.when((F.col("local") != BLANK) & (F.col("place") > F.col("first")), DUPLICATE).otherwise(F.col("local"))
        symbol = F.substring(F.lit(SYMBOLS), 4 * F.col("role") + fault + 1, F.lit(1))
        marked = small.join(repeated.drop("n"), "same", "left").select("conv_id", "place", symbol.alias("symbol"))
        per_segment = marked.groupBy("conv_id", F.shiftright("place", SEGMENT_BITS).alias("segment")).agg(
            F.sort_array(F.collect_list(F.struct("place", "symbol"))).alias("symbols")
        )
        return per_segment.withColumn("symbols", F.array_join(F.transform("symbols", lambda s: s.symbol), ""))

    def conversations(self) -> DataFrame:
        """``conv_id, blank, duplicate, truncated, illegal`` (neighbouring initials other than su, ua, au), ``cost`` and
        ``audit``: the edits' initials (K, R, D, I) in order."""
        return self.plans.filter("cost IS NOT NULL").drop("segment", "state", "edits")

    def gaps(self) -> DataFrame:
        """``conv_id, gaps``: numbers between the smallest and the greatest turn that no row has; 0 without turns, null
        where that is no long."""
        turns = self.rows.select("conv_id", "turn").distinct().groupBy("conv_id")
        wide = [F.col(c).cast("decimal(38,0)") for c in ("low", "high")]
        gaps = F.when(F.col("low").isNull(), 0).otherwise((wide[1] - wide[0] + 1 - F.col("n")).try_cast("long"))
        counted = turns.agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n"))
        return counted.select("conv_id", gaps.cast("long").alias("gaps"))

    def repaired(self, together: bool = False) -> DataFrame:
        """The repaired rows: ``conv_id, position`` (ascending in order, with gaps), ``role, text, edit`` (K, R or I) and
        ``turn`` (null for an inserted row).

        A long conversation is dealt out by segments. ``together`` brings all rows of a conversation, in order, into
        one stream, for what can only be done one row after the other.
        """
        parts = self.plans.select(
            "conv_id", "segment", F.lit(0).alias("kind"), F.col("state").cast("long").alias("place"),
            F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("edits").alias("text"),
        )
        rows = self.rows.select(
            "conv_id", F.shiftright("place", SEGMENT_BITS).alias("segment"), F.lit(1).alias("kind"), "place", "turn", "role", "text"
        )
        keys = ["conv_id"] if together else ["conv_id", "segment"]
        dealt = parts.unionByName(rows).repartition(*keys).sortWithinPartitions("conv_id", "segment", "kind", "place")
        return dealt.mapInArrow(_edited, "conv_id long, position long, role string, text string, edit string, turn long")


_EDITED = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    + [("edit", pa.string()), ("turn", pa.int64())]
)
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their edits in front, edit by edit; only the edits of one segment are held."""
    waiting: list[tuple] = []
    size, conv_id, position, state, edits, at = 0, None, 0, START, "", 0
    names = {USER: "user", ASSISTANT: "assistant"}

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*waiting), _EDITED)], schema=_EDITED)

    def inserted() -> None:
        nonlocal state, position, at
        while at < len(edits) and edits[at] == "I":
            state, at = NEXT[state], at + 1
            waiting.append((conv_id, position, names[state], "", "I", None))
            position += 1

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "kind", "place", "turn", "role", "text"))
        for conv_id, segment, kind, place, turn, role, text in zip(*columns):
            if kind == 0:
                state, edits, at, position = place, text, 0, segment * PLACES
            else:
                edit, at = edits[at], at + 1
                if edit != "D":
                    state = NEXT[state] if edit == "R" else _INITIALS[role[0]]
                    waiting.append((conv_id, position, names[state] if edit == "R" else role, text, edit, turn))
                    size += len(text)
                    position += 1
            inserted()
            if size > PATIENCE:
                yield batch_of()
                waiting, size = [], 0
    if waiting:
        yield batch_of()


def with_damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2 removes the text's ``.!?``,
    3 repeats it, 4 makes its role user. Nulls are one space, in the hashed key too."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    conv_id, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in rows.columns)
    damage = F.crc32(F.concat(conv_id, F.lit(":"), turn).cast("binary")) % 20
    rows = rows.withColumn("_damage", damage).filter("_damage > 0").select(
        "conv_id", "turn", F.when(F.col("_damage") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_damage") == 1, "").when(F.col("_damage") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")


def row_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``repaired(together=True)``: the digest of its lines ``role:text``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running, done = None, None, []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if running is None or conv_id != current:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = conv_id, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
        if running is not None:
            done.append((current, running.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], ["conv_id", "repaired_sha256"]
        )

    return repaired.mapInArrow(digest, "conv_id long, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame, work: Workspace) -> DataFrame:
    """One row per conversation id of ``conversations`` with the figures, edits and digest of its repaired ``rows``."""
    repair = Repair(rows, work)
    ids = pick(conversations, conv_id="conv_id").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    report = ids
    for part in (repair.conversations(), repair.gaps(), row_digests(repair.repaired(together=True))):
        part = part.withColumnRenamed("conv_id", "_id")
        report = report.join(part, report["conv_id"].eqNullSafe(part["_id"]), "left").drop("_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    known = F.col("audit").isNotNull()
    return report.select(
        "conv_id",
        *[(F.when(known, F.col(c)).otherwise(0) if c == "gaps" else F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
