"""Operator 13: conversation structure repair by Knuth's lightest-derivation agenda.

Items are (rows read, state of the role pattern); a deduction takes an item and one arc of the
next span (a row, or a block of rows already summed up) and gives the item behind it. Weights are
(cost, audit). Every deduction adds to the cost and appends to the audit, so it is monotone and
superior: items popped in order of (cost, audit) are final, and so is the goal at its first pop.
Audits of one item and one cost never are prefixes of each other, as the letters fix the cost.

A conversation of up to ``GROUP_ROWS`` rows and ``GROUP_BYTES`` is gathered as one row by Spark;
only a letter for each of its lines reaches Python. Longer ones are dealt out by ranges of their
order, copies counted first; a task sums up each block of lines as its lightest arcs between
states, the agenda runs over blocks, and the blocks' parts of the audit go back to their lines.
Texts of such a conversation meet only in the stream that is hashed, since SHA-256 has one order.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from tidewatch.llm.arrow import batch_of
from tidewatch.llm.skew import attach
from tidewatch.session import cut_lineage

#: Lines and bytes of a conversation that Spark gathers in one row; longer ones take blocks.
GROUP_ROWS, GROUP_BYTES = 1024, 16 << 20
#: Places of the written order in a block, as a power of two.
BLOCK_BITS = 9
#: The role pattern (s?(ua)+)?: states are nothing, after s, after u, after a.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
#: The one initial that an inserted or rerole'd line can have in a state.
FREE = {0: "u", 1: "u", 2: "a", 3: "u"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Answers that a worker keeps by their letters.
CACHED = 20_000
ROLES = {"u": "user", "a": "assistant"}


@functools.cache
def arcs(letter: str) -> dict[int, list[tuple[int, int, str]]]:
    """state -> (next state, cost, audit letter) of one line. ``letter``: the initial s, u, a or x
    (another), in upper case if the line is truncated; D for one that must go."""
    out = {q: [(q, DELETE, "D")] for q in range(4)}
    if letter != "D":
        more = TRUNCATED if letter.isupper() else 0
        for q, edits in out.items():
            edits.append((NEXT[q, FREE[q]], REROLE + more, "R"))
            if (q, letter.lower()) in NEXT:
                edits.append((NEXT[q, letter.lower()], more, "K"))
    return out


INSERTS = {q: (NEXT[q, FREE[q]], INSERT, "I") for q in range(4)}


def agenda(spans, entry: int, insert: bool = True):
    """Final items at the end of ``spans``, lightest first: state, cost, audit, trail.

    ``spans``: for each, state -> arcs. The trail has the state before each arc taken, and the arc's audit.
    """
    waiting, final, back = [(0, "", 0, entry, None, "")], {}, {}
    while waiting:
        cost, audit, i, q, source, step = heapq.heappop(waiting)
        if (i, q) in final:
            continue
        final[i, q] = cost, audit
        back[i, q] = source, step
        if i == len(spans):
            trail, at = [], (i, q)
            while back[at][0] is not None:
                before, step = back[at]
                trail.append((before[1], step))
                at = before
            yield q, cost, audit, trail[::-1]
        else:
            for to, c, a in spans[i][q]:
                if (i + 1, to) not in final:
                    heapq.heappush(waiting, (cost + c, audit + a, i + 1, to, (i, q), a))
        if insert:
            to, c, a = INSERTS[q]
            if (i, to) not in final:
                heapq.heappush(waiting, (cost + c, audit + a, i, to, (i, q), a))


@functools.lru_cache(CACHED)
def lightest(letters: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    return next((c, a) for q, c, a, _ in agenda([arcs(x) for x in letters], 0) if q in FINAL)


@functools.lru_cache(CACHED // 100)
def summed(letters: str) -> list[tuple[int, int, int, str]]:
    """A block of lines as arcs: state before, state after, cost, audit."""
    spans = [arcs(x) for x in letters]
    return [(p, q, c, a) for p in range(4) for q, c, a, _ in agenda(spans, p)]


def fates(lines: list[str], entry: int, audit: str) -> list[str]:
    """What becomes of each line: u or a for a line inserted before (or, at the end, behind) it, K kept,
    U or A with another role, nothing if deleted. ``lines``: their letters, one or, with copies, more."""
    out, q, row, left = [""] * len(lines), entry, 0, len(lines[0]) if lines else 0
    for edit in audit:
        if edit != "I" and not left:
            row += 1
            left = len(lines[row])
        if edit == "I":
            at = row + 1 if not left and row + 1 < len(lines) else row
            out[at] += FREE[q]
            q = NEXT[q, FREE[q]]
            continue
        letter = lines[row][len(lines[row]) - left].lower()
        left -= 1
        if edit == "K":
            out[row] += "K"
            q = NEXT[q, letter]
        elif edit == "R":
            out[row] += FREE[q].upper()
            q = NEXT[q, FREE[q]]
    return out


SOLVED = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("fates", pa.list_(pa.string()))])


@F.arrow_udf(StructType().add("cost", LongType()).add("audit", StringType()).add("fates", ArrayType(StringType())))
def _solve(lines: pa.Array) -> pa.Array:
    out = []
    for letters in lines.to_pylist():
        cost, audit = lightest("".join(letters))
        out.append({"cost": cost, "audit": audit, "fates": fates(letters, 0, audit)})
    return pa.array(out, SOLVED)


ARCS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


@F.arrow_udf(ArrayType(StructType().add("p", IntegerType()).add("q", IntegerType()).add("cost", LongType())
                        .add("audit", StringType())))
def _sum_up(lines: pa.Array) -> pa.Array:
    return pa.array([[dict(zip("p q cost audit".split(), arc)) for arc in summed("".join(letters))]
                     for letters in lines.to_pylist()], ARCS)


@F.arrow_udf(ArrayType(StringType()))
def _fates(lines: pa.Array, entry: pa.Array, audit: pa.Array) -> pa.Array:
    return pa.array(map(fates, lines.to_pylist(), entry.to_pylist(), audit.to_pylist()), pa.list_(pa.string()))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone, after the damage that crc32(`conv_id:turn`) % 20 names: 0 drops a row
    (it stays, as gone, without text), 1 empties its text, 2 takes its marks `.!?`, 3 repeats it, 4 makes it the
    user's. A null counts as one space, but stays null in conv_id and turn."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    ).select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("gone"),
             F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
             ).drop("copy")


def _initial(role: str = "role") -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def _fault(seen: Column) -> Column:
    """blank, duplicate, truncated or empty: the first that holds."""
    return (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(seen, "duplicate")
            .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise(""))


def _letter(fault: Column, initial: Column) -> Column:
    return F.when(fault.isin("blank", "duplicate"), "D").when(fault == "truncated", F.upper(initial)).otherwise(initial)


def _legal(initials: Column) -> Column:
    """Neighbouring initials that may follow each other."""
    return F.regexp_count(initials, F.lit("(?=su|ua|au)")).cast("long")


def _lines(fate: Column, role: Column, text: Column) -> Column:
    """The lines that a row leaves: an array of ``role:text``."""
    return F.transform(F.filter(F.split(fate, ""), lambda c: c != ""), lambda c: (
        F.when(c == "K", F.concat(role, F.lit(":"), text))
        .otherwise(F.concat(F.when(F.lower(c) == "u", ROLES["u"]).otherwise(ROLES["a"]), F.lit(":"),
                            F.when(c.isin("U", "A"), text).otherwise("")))))


def _gaps(low: Column, high: Column, distinct: Column) -> Column:
    span = high.cast("decimal(38,0)") - low.cast("decimal(38,0)") + 1 - distinct.cast("decimal(38,0)")
    return F.coalesce(span.try_cast("long"), F.lit(0)).cast("long")


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _short(lines: DataFrame) -> DataFrame:
    """Conversations of bounded size, each gathered once."""
    same = Window.partitionBy("conv_id", "role", "text", "gone").orderBy("turn")
    dealt = lines.repartition("conv_id").withColumn("fault", _fault(F.row_number().over(same) > 1))
    line = F.struct("turn", "role", "text", "fault", _letter(F.col("fault"), _initial()).alias("letter"),
                    _initial().alias("initial"))
    held = dealt.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(~F.col("gone"), line))).alias("lines"),
        F.collect_set(F.when(~F.col("gone"), F.col("turn"))).alias("turns"),
        *[F.count(F.when(~F.col("gone") & (F.col("fault") == f), 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    solved = held.withColumn("solved", _solve(F.col("lines.letter")))
    initials = F.array_join("lines.initial", "")
    text = F.array_join(F.flatten(F.zip_with("lines", "solved.fates", lambda r, f: _lines(f, r.role, r.text))), "\n")
    return solved.select(
        "conv_id", _gaps(F.array_min("turns"), F.array_max("turns"), F.size("turns")).alias("gaps"),
        "blank", "duplicate", "truncated",
        F.greatest(F.length(initials) - 1 - _legal(initials), F.lit(0)).cast("long").alias("illegal"),
        "solved.cost", "solved.audit", F.sha2(text, 256).alias("repaired_sha256"))


def _joined_blocks(table: pa.Table) -> pa.Table:
    """The agenda over one conversation's blocks: entry state and part of the audit for each."""
    table = table.sort_by("block")
    rows = table.to_pylist()
    spans = [{p: [(a["q"], a["cost"], a["audit"]) for a in r["arcs"] if a["p"] == p] for p in range(4)} for r in rows]
    trail = next(t for q, _, _, t in agenda(spans, 0, insert=False) if q in FINAL)
    cost, ends = [], [q for q, _ in trail[1:]]
    for k, (entry, part) in enumerate(trail):
        cost.append(next(c for to, c, a in spans[k][entry] if a == part and (k == len(ends) or to == ends[k])))
    across = [int(a["last"] + b["first"] in ("su", "ua", "au")) for a, b in zip(rows, rows[1:])] + [0]
    return pa.table({"conv_id": table.column("conv_id"), "block": table.column("block"),
                     "entry": pa.array([q for q, _ in trail], pa.int32()),
                     "part": pa.array([a for _, a in trail], pa.string()), "cost": pa.array(cost, pa.int64()),
                     "legal": pa.array([r["legal"] + x for r, x in zip(rows, across)], pa.int64()),
                     "size": table.column("size")})


def _hashed(batches):
    """SHA-256 of each conversation's lines, from rows in their order."""
    held, digest, empty = None, None, True

    def out():
        return batch_of(schema, pa.array([held[0]], schema[0].type), [digest.hexdigest()])

    for batch in batches:
        schema = pa.schema([("conv_id", batch.schema.field(0).type), ("repaired_sha256", pa.string())])
        for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is None or held[0] != conv:
                if held is not None:
                    yield out()
                held, digest, empty = (conv,), hashlib.sha256(), True
            if line is not None:
                digest.update((line if empty else "\n" + line).encode())
                empty = False
    if held is not None:
        yield out()


def _long(lines: DataFrame) -> DataFrame:
    """Conversations of any size, in blocks."""
    kept = lines.filter("NOT gone")
    once = kept.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    own = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit("/"), F.col("conv_id").isNull().cast("string"),
                   F.lit("/"), F.length("role").cast("string"), F.lit("/"), "role", "text")
    once = cut_lineage(once.withColumn("own", F.sha2(own, 256)), "lines")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = cut_lineage(once.groupBy("own").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")), "first")
    marked = attach(once, first, ["own"]).withColumn("fault", _fault(F.lit(False))).withColumn(
        "later", (order > F.col("first")) & (F.col("fault") != "blank"))
    size = F.lit(1 << BLOCK_BITS).cast("long")
    parts = marked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / size))))
    many = F.least(F.col("copies") - F.col("chunk") * size, size).cast("int")
    head = F.when(F.col("later") | (F.col("chunk") > 0), "D").otherwise(_letter(F.col("fault"), _initial()))
    parts = parts.select("conv_id", "turn", "role", "text", "chunk", "fault", "later",
                         F.concat(head, F.repeat(F.lit("D"), many - 1)).alias("letters"),
                         F.repeat(_initial(), many).alias("initials"))
    place = ["conv_id", "turn", "role", F.substring("text", 1, 64)]
    placed = parts.repartitionByRange(*place).sortWithinPartitions("conv_id", "turn", "role", "text", "chunk")
    placed = cut_lineage(placed.withColumn("at", F.monotonically_increasing_id()), "placed")

    blocks = placed.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "letters", "initials"))).alias("lines"))
    initials = F.array_join("lines.initials", "")
    blocks = cut_lineage(blocks.select(
        "conv_id", "block", F.col("lines.at").alias("at"), F.col("lines.letters").alias("letters"),
        _legal(initials).alias("legal"), F.length(initials).cast("long").alias("size"),
        F.substring(initials, 1, 1).alias("first"), F.substring(initials, -1, 1).alias("last")), "blocks")
    arced = blocks.drop("at").withColumn("arcs", _sum_up("letters")).drop("letters")
    kind = lines.schema["conv_id"].dataType.simpleString()
    path = cut_lineage(arced.groupBy("conv_id").applyInArrow(_joined_blocks, (
        f"conv_id {kind}, block long, entry int, part string, cost long, legal long, size long")), "path")

    whole = path.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), (F.sum("size") - 1 - F.sum("legal")).alias("illegal"),
        F.array_join(F.sort_array(F.collect_list(F.struct("block", "part"))).getField("part"), "").alias("audit"))
    copies = F.length("letters").cast("long")
    none = F.lit(0).cast("long")
    head_row = ~F.col("later") & (F.col("chunk") == 0)
    counts = placed.groupBy("conv_id").agg(
        F.sum(F.when(F.col("fault") == "blank", copies).otherwise(none)).alias("blank"),
        F.sum(F.when(F.col("fault") != "blank", copies - head_row.cast("long")).otherwise(none)).alias("duplicate"),
        F.sum(F.when((F.col("fault") == "truncated") & head_row, 1).otherwise(0)).alias("truncated"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"))
    met = blocks.alias("b").join(path.select(F.col("conv_id").alias("c"), F.col("block").alias("k"), "entry", "part"),
                                 F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("k")))
    fate = met.withColumn("fates", _fates("letters", "entry", "part")).select(
        F.explode(F.arrays_zip("at", "fates")).alias("x")).select("x.at", "x.fates")
    text = placed.select("conv_id", "at", "role", "text").join(fate, "at")
    line = _lines(F.col("fates"), F.col("role"), F.col("text"))
    stream = text.select("conv_id", F.when(F.length("fates") > 0, F.array_join(line, "\n")).alias("line"), "at")
    digest = stream.repartition("conv_id").sortWithinPartitions("conv_id", "at").select("conv_id", "line").mapInArrow(
        _hashed, f"conv_id {kind}, repaired_sha256 string")

    def same(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnRenamed("conv_id", "other")
        return a.join(b, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")

    named = lines.select("conv_id").distinct()
    out = same(same(same(named, whole), counts), digest)
    zero = {c: 0 for c in ("cost", "illegal", "blank", "duplicate", "truncated")}
    return out.withColumn("gaps", _gaps(F.col("low"), F.col("high"), F.col("turns"))).fillna(
        {**zero, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}).select(REPORT)


def repair(lines: DataFrame, group_rows: int = GROUP_ROWS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Faults and the cheapest repair of each conversation.

    ``lines``: conv_id (any type that groups, null is a conversation too), turn (long, nulls come first), role and
    text (no nulls), gone (true: the row counts for nothing but names its conversation). Lines are taken by turn;
    those of one turn by role, then text (no order of the input is used, so splits don't matter). Role initials
    other than s, u, a, and empty roles, fit nowhere. A repeated row is a duplicate. Returns a row for each conv_id
    (an empty table gives none): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; without
    lines zeros, an empty audit and the hash of nothing. ``group_rows`` and ``group_bytes`` say which conversations
    are gathered whole; they change no result. Reads its input twice: give a table, or a projection of one.
    """
    slim = lines.select("conv_id", "turn", "role", "text", "gone")
    sizes = slim.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    large = cut_lineage(sizes.filter((F.col("n") > group_rows) | (F.col("bytes") > group_bytes)), "large")
    if large.isEmpty():
        return _short(slim)
    total = sizes.agg(F.sum("n")).first()[0]
    name = large.select(F.col("conv_id").alias("large_id"), "n")
    # conversations of more than a thousandth of all rows (fewer than 1,000) are told apart where the rows are
    hot, warm = name.filter(F.col("n") > total / 1000), name.filter(F.col("n") <= total / 1000)
    is_it = F.col("conv_id").eqNullSafe(F.col("large_id"))
    rest = slim.join(F.broadcast(hot), is_it, "left_anti")
    long = slim.join(F.broadcast(hot), is_it, "left_semi").unionByName(rest.join(warm, is_it, "left_semi"))
    return _short(rest.join(warm, is_it, "left_anti")).unionByName(_long(cut_lineage(long, "long")))
