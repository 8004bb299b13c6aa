"""Conversations with lost, damaged or misplaced turns, repaired at least cost.

Roles of a sound conversation read ``(s?(ua)+)?`` by initials. Kept, reroled, deleted and inserted rows lead through four states:
nothing yet, after system, after user, after assistant. Costs are vectors over these states. Hirschberg's divide and conquer
finds the edits: the forward vector from the start and the backward vector from the end meet mid-conversation, the crossing
state is chosen among those of least total cost, and both halves are solved alone. So no table of rows by states is kept,
only two vectors and the edits.

*Ties.* Among the cheapest repairs the audit (edits' initials in order) that sorts first counts. Forward vectors carry the order
of the states' best audits besides their costs. That is enough: in one half every audit has a letter for each row and ends in
one, so none is the beginning of another, and different states have different audits.

*Long conversations* are cut into segments of ``SEGMENT`` rows; a conversation that fits one is solved where it is. Else each
segment becomes a matrix, the least costs from state to state and the order of their audits; the same divide and conquer over
a conversation's matrices gives the states at the cuts, and segments are then solved on their own. No task holds a conversation's rows: one holds a segment, or a
conversation's matrices, a few hundred bytes for ``SEGMENT`` rows. A repaired conversation's hash goes over its segments in
order, a batch of them at a time.

Defined cases: rows are ordered by turn, null first, then role and text; a null role or text is one space; a role whose initial is
none of s, u, a (an empty one too) can only be reroled or deleted; repeated rows are rows of their own; a null ``conv_id`` is a
conversation of its own; empty input gives no row; columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import row_numbers
from ..sources.staging import staged

SEGMENT = 1_000
STATES = range(4)  # nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = STATES
ENDS = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")  # initials of neighbours
WORD = r"[^\x20\x09-\x0D]"  # a character that is no white space

_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_DUE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what a reroled or inserted row leads to
ROLES = {USER: "user", ASSISTANT: "assistant"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # more for a truncated row that is not deleted

    def __post_init__(self) -> None:
        if min(self.rerole, self.delete, self.truncated) < 0 or self.insert < 1:
            raise ValueError("costs are not negative, and an inserted row costs something")


#: (cost, audit) of the best way from state to state, none where there is no way.
Moves = tuple[tuple[tuple[int, str] | None, ...], ...]


def _inserted(q: int, costs: Costs) -> list[tuple[int, int, str]]:
    """(state, cost, audit) reached from ``q`` by insertions: another state at most once."""
    out = []
    for n in range(3):
        if all(q != x for x, _, _ in out):
            out.append((q, n * costs.insert, "I" * n))
        q = _DUE[q]
    return out


@lru_cache(maxsize=64)
def row_moves(kind: str, costs: Costs) -> Moves:
    """Moves of one row and the insertions before it. ``kind`` is its role's initial and its fault's (or a space); empty: the end."""
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]

    def offer(q: int, to: int, cost: int, audit: str) -> None:
        if table[q][to] is None or (cost, audit) < table[q][to]:
            table[q][to] = (cost, audit)

    for q in STATES:
        for at, cost, audit in _inserted(q, costs):
            if not kind:
                if at in ENDS:
                    offer(q, at, cost, audit)
                continue
            offer(q, at, cost + costs.delete, audit + "D")
            if kind[1] not in "bd":
                more = costs.truncated * (kind[1] == "t")
                offer(q, _DUE[at], cost + costs.rerole + more, audit + "R")
                if at in _AFTER.get(kind[0], {}):
                    offer(q, _AFTER[kind[0]][at], cost + more, audit + "K")
    return tuple(map(tuple, table))


#: A step for vectors: from each state the (state, cost, place among that state's audits) it leads to.
Step = tuple[tuple[tuple[int, int, int], ...], ...]


def step_of(moves: Moves) -> Step:
    out = []
    for ways in moves:
        order = sorted((way[1], to) for to, way in enumerate(ways) if way is not None)
        out.append(tuple((to, ways[to][0], place) for place, (_, to) in enumerate(order)))
    return tuple(out)


#: For each state (cost, place of its best audit among the states'), or none.
Vector = tuple[tuple[int, int] | None, ...]


def only(state: int) -> Vector:
    return tuple((0, 0) if q == state else None for q in STATES)


@lru_cache(maxsize=1 << 16)
def _pushed(vector: Vector, step: Step) -> tuple[int, Vector]:
    """The vector behind a step, its least cost taken out; there are few such vectors, so most are known."""
    best: dict[int, tuple[int, int, int]] = {}
    for q, known in enumerate(vector):
        if known is not None:
            for to, cost, place in step[q]:
                found = (known[0] + cost, known[1], place)
                if to not in best or found < best[to]:
                    best[to] = found
    base = min((b[0] for b in best.values()), default=0)
    order = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][1:]))}
    return base, tuple((best[q][0] - base, order[q]) if q in best else None for q in STATES)


def forward(vector: Vector, steps: Sequence[Step]) -> tuple[int, Vector]:
    """(cost common to all, the vector behind all steps)."""
    total = 0
    for step in steps:
        base, vector = _pushed(vector, step)
        total += base
    return total, vector


@lru_cache(maxsize=1 << 16)
def _pulled(ahead: tuple[int | None, ...], step: Step) -> tuple[int | None, ...]:
    """Least costs to go before a step, from those behind it, the least taken out."""
    out = []
    for ways in step:
        costs = [cost + ahead[to] for to, cost, _ in ways if ahead[to] is not None]
        out.append(min(costs) if costs else None)
    base = min((c for c in out if c is not None), default=0)
    return tuple(None if c is None else c - base for c in out)


def crossings(steps: Sequence[Step], first: int, last: int) -> list[int]:
    """The states before, between and behind ``steps`` on the best way from ``first`` to ``last``."""
    out = [first]

    def solve(low: int, high: int, first: int, last: int) -> None:
        if high - low == 1:
            out.append(last)
            return
        mid = (low + high) // 2
        _, here = forward(only(first), steps[low:mid])
        ahead: tuple[int | None, ...] = tuple(0 if q == last else None for q in STATES)
        for at in range(high - 1, mid - 1, -1):
            ahead = _pulled(ahead, steps[at])
        meet = min((here[q][0] + ahead[q], here[q][1], q) for q in STATES if here[q] is not None and ahead[q] is not None)[2]
        solve(low, mid, first, meet)
        solve(mid, high, meet, last)

    if steps:
        solve(0, len(steps), first, last)
    return out


def audit_pieces(moves: Sequence[Moves], first: int, last: int) -> list[str]:
    """For each of ``moves`` its part of the audit of the best way from ``first`` to ``last``."""
    states = crossings([_step(m) for m in moves], first, last)
    return [m[a][b][1] for m, a, b in zip(moves, states, states[1:])]


@lru_cache(maxsize=64)
def _step(moves: Moves) -> Step:
    return step_of(moves)


def _cheapest(steps: Sequence[Step]) -> tuple[int, int]:
    """(cost, last state) of the best way through all ``steps``, the end's included."""
    base, behind = forward(only(START), steps)
    known, last = min((known, q) for q, known in enumerate(behind) if known is not None)
    return base + known[0], last


def segment_step(steps: Sequence[Step]) -> Step:
    """A whole segment as one step."""
    out = []
    for q in STATES:
        base, vector = forward(only(q), steps)
        out.append(tuple((to, base + known[0], known[1]) for to, known in enumerate(vector) if known is not None))
    return tuple(out)


def repaired_rows(audit: str, state: int, roles: Sequence[str], texts: Sequence[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of what the edits leave of rows, from ``state`` on."""
    row = 0
    for edit in audit:
        if edit == "K":
            yield roles[row], texts[row]
            state = _AFTER[roles[row][:1]][state]
        elif edit != "D":
            state = _DUE[state]
            yield ROLES[state], "" if edit == "I" else texts[row]
        row += edit != "I"


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, n, turn, role, text, fault, kind) of ``rows`` (conv_id, turn, role, text); n counts a conversation's rows from 0.

    No window holds a conversation: rows are numbered over ranges, and a row is a duplicate unless it is the first of its role
    and text, found by an aggregate.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    named = rows.select("conv_id", F.col("turn").isNotNull().alias("known"), "turn", space("role"), space("text"))
    numbered = row_numbers(named, ["conv_id"], ["known", "turn", "role", "text"], "n").withColumn("n", F.col("n") - 1)
    numbered = staged(numbered.drop("known"), "numbered")
    said = numbered.where(F.col("text").rlike(WORD))
    # The digest stands for role and text.
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = said.groupBy("conv_id", digest.alias("digest")).agg(F.min("n").alias("first"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), "first")
    found = numbered.join(firsts, numbered["conv_id"].eqNullSafe(firsts["_conv"]) & (F.col("n") == F.col("first")), "left")
    end = F.regexp_extract("text", rf"({WORD})[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(WORD), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~end.rlike(r"^[.!?]"), "truncated")
        .otherwise("")
    )
    initial = F.substring("role", 1, 1)
    kind = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("?"), F.rpad(F.substring("fault", 1, 1), 1, " "))
    return found.withColumn("fault", fault).withColumn("kind", kind).drop("_conv", "first")


def _segments(rows: DataFrame) -> DataFrame:
    """(conv_id, segment, kinds): at most ``SEGMENT`` rows' kinds in one text, two letters a row."""
    cut = rows.select("conv_id", F.floor(F.col("n") / SEGMENT).alias("segment"), "n", "kind")
    ordered = F.array_sort(F.collect_list(F.struct("n", "kind")))
    return cut.groupBy("conv_id", "segment").agg(F.array_join(F.transform(ordered, lambda x: x["kind"]), "").alias("kinds"))


def _moves(kinds: str, costs: Costs) -> list[Moves]:
    return [row_moves(kinds[i : i + 2], costs) for i in range(0, len(kinds), 2)]


def _illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _from_text(step: str) -> Step:
    return tuple(tuple(map(tuple, ways)) for ways in json.loads(step))


def repair(rows: DataFrame, costs: Costs = Costs()) -> tuple[DataFrame, DataFrame]:
    """(conversations, segments) of ``rows`` (``with_faults``).

    Conversations: (conv_id, illegal, cost, audit, repaired_sha256), the first a count of neighbours that are not ``LEGAL``, the
    last of ``role:text`` lines joined by newlines. Segments: (conv_id, segment, first, last, audit, ..), the states around
    each and its part of the audit; ``repaired_texts`` gives the rows.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()
    segments = staged(_segments(rows), "segments")
    several = segments.where("segment > 0").select(F.col("conv_id").alias("_conv")).distinct()
    same = segments["conv_id"].eqNullSafe(several["_conv"])
    short, long = segments.join(several, same, "left_anti"), segments.join(several, same, "left_semi")

    @F.pandas_udf("last int, cost bigint, illegal bigint, audit string")
    def whole(kinds: pd.Series) -> pd.DataFrame:
        known: dict[str, tuple] = {}  # alike conversations are solved once a batch
        for k in kinds:
            if k not in known:
                moves = [*_moves(k, costs), row_moves("", costs)]
                cost, last = _cheapest([_step(m) for m in moves])
                pieces = audit_pieces(moves, START, last)
                known[k] = (last, cost, _illegal(k[::2]), "".join(pieces))
        return pd.DataFrame([known[k] for k in kinds], columns=["last", "cost", "illegal", "audit"])

    @F.pandas_udf("step string, illegal bigint, ends string")
    def matrix(kinds: pd.Series) -> pd.DataFrame:
        steps = [json.dumps(segment_step([_step(m) for m in _moves(k, costs)])) for k in kinds]
        return pd.DataFrame({"step": steps, "illegal": [_illegal(k[::2]) for k in kinds], "ends": [k[0] + k[-2] for k in kinds]})

    def cross(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("segment", ignore_index=True)
        steps = [*map(_from_text, batch["step"]), _step(row_moves("", costs))]
        cost, last = _cheapest(steps)
        states = crossings(steps, START, last)
        n = len(batch)
        # Neighbours inside segments, and those at the cuts.
        illegal = int(batch["illegal"].sum()) + sum(a[1] + b[0] not in LEGAL for a, b in zip(batch["ends"], batch["ends"][1:]))
        return pd.DataFrame(
            {
                "conv_id": batch["conv_id"],
                "segment": batch["segment"],
                "first": states[:n],
                "last": states[1 : n + 1],
                "end": [None] * (n - 1) + [last],
                "cost": [cost] * n,
                "illegal": [illegal] * n,
            }
        ).astype({"end": "Int32"})

    steps = long.select("conv_id", "segment", matrix("kinds").alias("m")).select("conv_id", "segment", "m.*")
    schema = f"conv_id {conv}, segment bigint, first int, last int, end int, cost bigint, illegal bigint"
    met = steps.groupBy("conv_id").applyInPandas(cross, schema)

    @F.pandas_udf("string")
    def edits(kinds: pd.Series, first: pd.Series, last: pd.Series, end: pd.Series) -> pd.Series:
        out = []
        for k, a, b, e in zip(kinds, first, last, end):
            tail = "" if pd.isna(e) else row_moves("", costs)[int(b)][int(e)][1]
            out.append("".join(audit_pieces(_moves(k, costs), int(a), int(b))) + tail)
        return pd.Series(out, dtype=object)

    met = met.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "first", "last", "end", "cost", "illegal")
    solved = long.join(met, long["conv_id"].eqNullSafe(met["_conv"]) & (long["segment"] == met["_segment"]))
    solved = solved.select("conv_id", "segment", "first", "last", "cost", "illegal", edits("kinds", "first", "last", "end").alias("audit"))
    alone = short.select("conv_id", "segment", F.lit(START).alias("first"), whole("kinds").alias("w"))
    solved = staged(alone.select("conv_id", "segment", "first", "w.*").unionByName(solved), "solved")
    part = F.array_sort(F.collect_list(F.struct("segment", "audit")))
    audits = solved.groupBy("conv_id").agg(
        F.max("illegal").alias("illegal"), F.max("cost").alias("cost"), F.array_join(F.transform(part, lambda x: x["audit"]), "").alias("audit")
    )
    digests = _digests(repaired_texts(rows, solved), conv)
    digests = digests.select(F.col("conv_id").alias("_conv"), "repaired_sha256")
    whole = audits.join(digests, audits["conv_id"].eqNullSafe(digests["_conv"])).drop("_conv")
    return whole, solved


def repaired_texts(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv_id, segment, turns): what ``segments`` (of ``repair``) leave of ``rows``, as arrays of (role, text)."""
    ordered = F.array_sort(F.collect_list(F.struct("n", "role", "text")))
    texts = rows.groupBy(F.col("conv_id").alias("_conv"), F.floor(F.col("n") / SEGMENT).alias("_segment")).agg(ordered.alias("rows"))

    @F.pandas_udf("array<struct<role:string,text:string>>")
    def turns(audit: pd.Series, first: pd.Series, roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([list(repaired_rows(a, q, r, t)) for a, q, r, t in zip(audit, first, roles, texts)], dtype=object)

    together = segments.join(texts, segments["conv_id"].eqNullSafe(texts["_conv"]) & (segments["segment"] == texts["_segment"]))
    return together.select("conv_id", "segment", turns("audit", "first", F.col("rows.role"), F.col("rows.text")).alias("turns"))


def _digests(repaired: DataFrame, conv: str) -> DataFrame:
    """(conv_id, repaired_sha256): a conversation's segments pass in order, and only its running hash is kept."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    body = repaired.select("conv_id", "segment", F.size("turns").alias("n"), F.array_join(lines, "\n").alias("body"))
    in_order = body.repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, spoken = None, None, False
        for batch in batches:
            out = []
            for conv_id, n, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n", "body"))):
                if state is None or conv_id != own:
                    if state is not None:
                        out.append((own, state.hexdigest()))
                    own, state, spoken = conv_id, hashlib.sha256(), False
                if n:
                    state.update((("\n" if spoken else "") + text).encode())
                    spoken = True
            yield _digest_batch(out, batch.schema.field("conv_id").type)
        if state is not None:
            yield _digest_batch([(own, state.hexdigest())], batch.schema.field("conv_id").type)

    return in_order.mapInArrow(run, f"conv_id {conv}, repaired_sha256 string")


def _digest_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, digests = pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())
    return pa.RecordBatch.from_arrays([ids, digests], ["conv_id", "repaired_sha256"])
