"""Conversation repair by iterative-deepening A*.

A conversation's rows are taken by turn; each row is one symbol: the initial
of its role and its fault.  Edits (Delete, Insert, Keep, Rerole) turn the
symbols into role initials of the form ``(s?(ua)+)?``.  The cheapest edits
are searched depth first, in ASCII order of the edits' initials, under a
cost bound that starts at an admissible estimate and rises to the least
estimate that exceeded it; states that failed are kept in a table with the
cost they are known to need, and not entered again with less.  So the first
accepting path is the cheapest one, the ASCII-least where several are.

The estimate adds 3 per row that must go, 1 per truncated row and 1 per
neighbouring pair of other rows whose initials do not fit: a Rerole or Delete
touches two pairs, an Insert one, so no edit costs less than it mends.

Rows are sorted once by range of (conversation, turn), so a conversation of
any length is spread over tasks.  It is cut into segments of ``SEGMENT`` rows
at most.  Each segment is searched on its own from every state of the
grammar to every other (a conversation within one segment needs one search);
the segments' paths are then joined from the end.  That is exact, as a
prefix of the edits matters to the rest only by the state it leaves.  One
conversation meets in one task only for its path (a few bytes a row) and
where its rows are streamed in order, a row at a time.

Edge cases: NULL roles and texts count as one space; rows without turn come
first, as do smaller roles and then texts (first 64 characters, then a hash)
within one turn; an empty role has no initial, so it fits nowhere; roles
other than system, user and assistant are known by their initial alone;
NULL conversation ids form one conversation; a conversation without rows has
an empty path; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

SEGMENT_BITS = 6
SEGMENT = 1 << SEGMENT_BITS  # rows of a segment at most
BLANKS = " \t\n\x0b\x0c\r"
INITIALS = "suao"  # o: any other
KEPT, CUT, GONE = INITIALS, INITIALS.upper(), "0123"  # symbols of sound, truncated and unwanted rows

START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows so far end in
END = (START, ASSISTANT)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL_PAIRS = ("su", "ua", "au")
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 60  # a cost beyond any path


# ---- the search

def wanted(state: int) -> tuple[str, int]:
    """The role an inserted or reroled row takes, and the state after it."""
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def moves(symbol: str, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows used, next state) at a symbol ('' after the last), in ASCII order."""
    after = wanted(state)[1]
    out = [("I", INSERT, 0, after)]
    if symbol:
        out.insert(0, ("D", DELETE, 1, state))
        if symbol not in GONE:
            extra = TRUNCATED if symbol in CUT else 0
            kept = NEXT.get((state, symbol.lower()))
            if kept is not None:
                out.append(("K", extra, 1, kept))
            out.append(("R", REROLE + extra, 1, after))
    return out


MOVES = {(symbol, state): moves(symbol, state) for symbol in ["", *KEPT, *CUT, *GONE] for state in range(4)}


def reachable(system: bool, state: int, leave: int) -> bool:
    """Whether any edits lead to a state; START and SYSTEM are never inserted.  ``system``: a system row is still to come."""
    return leave in (USER, ASSISTANT) or state == leave or (leave == SYSTEM and state == START and system)


class Estimate:
    """Admissible cost of the rest, from every row and state."""

    def __init__(self, symbols: str, accept: tuple):
        n = len(symbols)
        self.accept = accept
        self.sum = [0] * (n + 1)  # unwanted, truncated and unfitting pairs from here on
        self.first = [""] * (n + 1)  # the next row that may stay
        self.system = [False] * (n + 1)
        for i in range(n - 1, -1, -1):
            symbol, after = symbols[i], self.first[i + 1]
            self.system[i] = self.system[i + 1] or symbol in "sS"
            if symbol in GONE:
                self.sum[i], self.first[i] = self.sum[i + 1] + DELETE, after
                continue
            letter = symbol.lower()
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(letter)
            fits = state in accept if not after else (state, after) in NEXT
            self.sum[i] = self.sum[i + 1] + (symbol in CUT) * TRUNCATED + (not fits)
            self.first[i] = letter

    def __call__(self, i: int, state: int) -> int:
        if not any(reachable(self.system[i], state, q) for q in self.accept):
            return NEVER
        first = self.first[i]
        if first:
            return self.sum[i] + ((state, first) not in NEXT)
        cost = self.sum[i]
        while state not in self.accept and cost < self.sum[i] + 2 * INSERT:
            cost, state = cost + INSERT, wanted(state)[1]
        return cost


def search(symbols: str, enter: int, accept: tuple) -> tuple[int, str, int]:
    """Cost, edits and last state of the cheapest, ASCII-least path from ``enter`` to an accepted state."""
    n = len(symbols)
    estimate = Estimate(symbols, accept)
    failed: dict[tuple[int, int], int] = {}  # state -> the cost it is known to need

    def least(i: int, state: int) -> int:
        known = failed.get((i, state))
        return estimate(i, state) if known is None else known

    limit = least(0, enter)
    while True:
        path: list[str] = []
        stack = [[0, enter, limit, iter(MOVES[symbols[:1], enter]), None]]
        while stack:
            frame = stack[-1]
            i, state, left, rest, _ = frame
            if i == n and state in accept:
                return limit - left, "".join(path), state
            for edit, cost, used, after in rest:
                need = cost + least(i + used, after)
                if need <= left:
                    at = i + used
                    path.append(edit)
                    stack.append([at, after, left - cost, iter(MOVES[symbols[at:at + 1], after]), None])
                    break
                if frame[4] is None or need < frame[4]:
                    frame[4] = need
            else:
                failed[i, state] = max(least(i, state), left + 1, frame[4])
                stack.pop()
                if stack:
                    path.pop()
                    need = stack[-1][2] - left + failed[i, state]
                    if stack[-1][4] is None or need < stack[-1][4]:
                        stack[-1][4] = need
        limit = failed[0, enter]


def segment_paths(symbols: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(enter, leave, cost, edits) of a segment, for every pair of states it may join."""
    out = []
    for enter in (START,) if first else range(4):
        for accept in (END,) if last else [(q,) for q in range(4)]:
            accept = tuple(q for q in accept if reachable("s" in symbols.lower(), enter, q))
            if accept:
                cost, edits, leave = search(symbols, enter, accept)
                out.append((enter, leave, cost, edits))
    return out


class Path:
    """Edits of a segment and what follows; paths are compared letter by letter."""

    def __init__(self, cost: int, enter: int, edits: str, rest: Path | None):
        self.cost, self.enter, self.edits, self.rest = cost, enter, edits, rest

    def parts(self) -> Iterator[Path]:
        part = self
        while part is not None:
            yield part
            part = part.rest

    def letters(self) -> Iterator[str]:
        for part in self.parts():
            yield from part.edits

    def before(self, other: Path) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        theirs = other.letters()
        for mine in self.letters():
            letter = next(theirs, "")
            if mine != letter:
                return mine < letter
        return next(theirs, "") != ""


def joined(segments: list[list]) -> Path:
    """The best path through the segments of a conversation, in order."""
    best: dict[int, Path | None] = {}
    for number, paths in enumerate(reversed(segments)):
        found: dict[int, Path] = {}
        for enter, leave, cost, edits in paths:
            rest = best.get(leave) if number else None
            if number and rest is None:
                continue
            path = Path(cost + (rest.cost if rest else 0), enter, edits, rest)
            if enter not in found or path.before(found[enter]):
                found[enter] = path
        best = found
    return best[START]


# ---- Spark side

PATHS = "array<struct<enter: int, leave: int, cost: long, edits: string>>"


def _paths():
    @F.pandas_udf(PATHS)
    def paths(symbols: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        names = ("enter", "leave", "cost", "edits")
        known: dict[tuple, list] = {}  # a batch repeats few kinds of segments
        for s in zip(symbols, first, last):
            if s not in known:
                known[s] = [dict(zip(names, p)) for p in segment_paths(*s)]
        return pd.Series([known[s] for s in zip(symbols, first, last)])

    return paths


def _join_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best path of every conversation, from its segments in order."""
    plan = pa.list_(pa.struct([("seg", pa.int64()), ("enter", pa.int32()), ("edits", pa.string())]))
    for batch in batches:
        cost, audit, plans = [], [], []
        for parts in batch.column("parts").to_pylist():
            path = joined([[(p["enter"], p["leave"], p["cost"], p["edits"]) for p in part["paths"]] for part in parts])
            chain = list(path.parts())
            cost.append(path.cost)
            audit.append("".join(p.edits for p in chain))
            plans.append([{"seg": part["seg"], "enter": p.enter, "edits": p.edits} for part, p in zip(parts, chain)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("illegal"), pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(plans, plan)],
            ["conv_id", "illegal", "cost", "audit", "plan"])


def crc(*columns: str) -> Column:
    return F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in columns]).cast("binary"))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that the row's checksum decides."""
    code = crc("conv_id", "turn") % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
                       F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       code.alias("code")).where("code <> 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, F.lit(2)).otherwise(F.lit(1))))).drop("code", "copy")


def ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with ``pos``, ascending in each conversation, and ``fault``: blank, truncated or NULL."""
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role, text)
    keys = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    rows = rows.withColumn("spread", F.rand(12)).repartitionByRange(*keys, "spread").sortWithinPartitions(*keys).drop("spread")
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(end == "", F.lit("blank")).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), F.lit("truncated"))
    return stored(rows.select("*", F.monotonically_increasing_id().alias("pos"), fault.alias("fault")), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, pos, symbol and the row's first fault, from ``ordered`` rows."""
    same = [F.col("conv_id"), F.col("role"), F.unhex(F.sha2("text", 256)).alias("digest")]
    thin = rows.select(*same, "turn", "pos", "fault")
    copies = thin.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = copies.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    fault = F.when((F.col("pos") > F.col("first")) & ~F.col("fault").eqNullSafe(F.lit("blank")), F.lit("duplicate")).otherwise(F.col("fault"))
    letter = F.substring("role", 1, 1)
    known = F.when(letter.isin("s", "u", "a"), letter).otherwise(F.lit("o"))
    return thin.join(copies, on, "left").select("conv_id", "turn", "pos", fault.alias("fault"), known.alias("letter")).withColumn(
        "symbol", F.when(F.col("fault") == "truncated", F.upper("letter"))
        .when(F.col("fault").isNotNull(), F.translate("letter", INITIALS, GONE)).otherwise(F.col("letter")))


def _illegal(pairs: Column) -> Column:
    return F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL_PAIRS))).cast("long")


def planned(marked: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit and the segments' ``plan`` (seg, enter, edits) from ``faults``."""
    seg = F.shiftright("pos", SEGMENT_BITS).alias("seg")
    symbols = F.array_sort(F.collect_list(F.struct("pos", "symbol", "letter")))
    parts = marked.groupBy("conv_id", seg).agg(symbols.alias("rows"))
    parts = parts.select("conv_id", "seg", F.array_join(F.col("rows.symbol"), "").alias("symbols"), F.col("rows.letter").alias("letters"))
    around = "OVER (PARTITION BY conv_id ORDER BY seg)"
    parts = parts.withColumns({"before": F.expr(f"lag(element_at(letters, -1)) {around}"),
                               "last": F.expr(f"lead(seg) {around} IS NULL")})
    letters = F.concat(F.when(F.col("before").isNotNull(), F.array("before")).otherwise(F.array().cast("array<string>")), F.col("letters"))
    pairs = F.zip_with(F.slice(letters, 1, F.size(letters) - 1), F.slice(letters, 2, F.size(letters)),
                       lambda x, y: F.concat(x, F.coalesce(y, F.lit(""))))
    parts = parts.select("conv_id", "seg", _illegal(pairs).alias("illegal"), _paths()("symbols", F.isnull("before"), "last").alias("paths"))
    whole = parts.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.array_sort(F.collect_list(F.struct("seg", "paths"))).alias("parts"))
    schema = T.StructType([whole.schema["conv_id"], whole.schema["illegal"], T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                           T.StructField("plan", T.ArrayType(T.StructType([
                               T.StructField("seg", T.LongType()), T.StructField("enter", T.IntegerType()), T.StructField("edits", T.StringType())])))])
    return stored(whole.mapInArrow(_join_task, schema), "plans")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of sorted rows, each segment's plan before its rows; a plan alone gives (conv_id, '', ...)."""
    state, edits, at = START, "", 0
    for batch in batches:
        for conv, enter, plan, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "enter", "edits", "role", "text"))):
            if plan is not None:
                state, edits, at = enter, plan, 0
                yield conv, "", None, None
            else:
                while edits[at] == "I":
                    new, state = wanted(state)
                    yield conv, "I", new, ""
                    at += 1
                edit, at = edits[at], at + 1
                if edit == "K":
                    state = NEXT[state, role[0]]
                elif edit == "R":
                    role, state = wanted(state)
                yield conv, edit, role, text
            if plan is None and not edits[at:].strip("I"):
                for _ in edits[at:]:
                    new, state = wanted(state)
                    yield conv, "I", new, ""
                at = len(edits)


def _rows_task(kind: pa.DataType):
    names = ["conv_id", "at", "edit", "role", "text"]
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]

    def batch_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n, out = object(), 0, []
        for conv, edit, role, text in _edited(batches):
            if conv != current:
                current, n = conv, 0
            if edit and edit != "D":
                out.append((conv, n, edit, role, text))
                n += 1
            if len(out) == 1000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    return run


def _digest_task(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, n, out = None, None, 0, []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind), pa.array([d for _, d in out], pa.string())], ["conv_id", "sha"])

        for conv, edit, role, text in _edited(batches):
            if digest is None or conv != current:
                if digest is not None:
                    out.append((current, digest.hexdigest()))
                    if len(out) == 1000:
                        yield batch_of()
                        out.clear()
                current, digest, n = conv, hashlib.sha256(), 0
            if edit and edit != "D":
                digest.update((("\n" if n else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                n += 1
        if digest is not None:
            out.append((current, digest.hexdigest()))
        yield batch_of()

    return run


def _streamed(rows: DataFrame, plans: DataFrame) -> tuple[DataFrame, pa.DataType]:
    """The rows of every conversation in order, each segment's plan before its first row."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    none = F.lit(None).cast("string")
    heads = plans.select("conv_id", F.explode("plan").alias("p")).select(
        "conv_id", F.shiftleft("p.seg", SEGMENT_BITS).alias("pos"), F.lit(0).alias("kind"),
        F.col("p.enter").alias("enter"), F.col("p.edits").alias("edits"), none.alias("role"), none.alias("text"))
    body = rows.select("conv_id", "pos", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("enter"), none.alias("edits"), "role", "text")
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")
    return both.select("conv_id", "enter", "edits", "role", "text"), to_arrow_type(kind)


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, at (from 0), edit, role, text of the repaired conversations, from ``ordered`` rows and ``planned``."""
    stream, kind = _streamed(rows, plans)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("at", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in ("edit", "role", "text")])
    return stream.mapInArrow(_rows_task(kind), schema)


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id and sha: SHA-256 of the repaired rows as ``role:text`` lines, hashed as they pass."""
    stream, kind = _streamed(rows, plans)
    return stream.mapInArrow(_digest_task(kind), T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("sha", T.StringType())]))


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows of ``conversations``: conv_id, at, edit, role, text."""
    rows = ordered(conversations)
    return repaired_rows(rows, planned(faults(rows)))


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per conversation of ``conversations``: gaps, faults, cost, audit and digest of its ``ordered`` rows."""
    marked = stored(faults(rows), "faults")
    plans = planned(marked)
    turns = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    kinds = ("blank", "duplicate", "truncated")
    counts = marked.groupBy("conv_id").agg(turns.alias("gaps"), *[F.count_if(F.col("fault") == k).alias(k) for k in kinds])
    names = ["gaps", *kinds, "illegal", "cost", "audit", "sha"]
    pieces = [conversations.select("conv_id").distinct(), counts, plans.select("conv_id", "illegal", "cost", "audit"), repaired_digests(rows, plans)]
    whole = pieces[0]
    for piece in pieces[1:]:
        whole = whole.unionByName(piece, allowMissingColumns=True)
    whole = whole.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in names])
    nothing = hashlib.sha256().hexdigest()
    return whole.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names[:6]],
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"))


def op12_iterative_deepening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return report(rows, ordered(damaged(rows)))
