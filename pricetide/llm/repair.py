"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is a row of turns; the cheapest edits that give role initials ``(s?(ua)+)?`` are wanted. The costs to go
are a vector over the four states of that pattern (nothing yet, after s, after u, after a), computed from the last turn
back to the first. A conversation is cut into chunks of turns, so that one conversation may hold any share of all rows:

1. Every chunk runs back from a speculative vector at its end, all chunks at once, and keeps the vector behind each turn.
2. Fix-up passes: a chunk whose end vector differs from the start vector of the chunk after it by more than a constant
   runs again from there, until its vector at some turn differs from the kept one by a constant only; what lies before
   is the same up to that constant. Passes go on until no chunk has to run.
3. The constants are summed (the cost), and the vectors drive the tracing: at every turn the ASCII-least letter (D, I, K,
   R) whose cost is the least one. Every chunk is traced from each of the four states; the state in which it is really
   entered follows by composing these maps, doubling the distance in each round.

What leaves a task: one row per turn without its text, then one row per chunk (a few bytes a turn). The texts are sorted
once for the positions and once for the digest. SHA-256 runs over a whole conversation in order, so its lines pass one
task, as a stream of sorted rows that holds one batch and the letters of one chunk at a time.

Defined results. Null role, text, turn or id in the damage key: one space; a null ``conv_id`` is a conversation of its own.
Turns of one number: by role, then by a digest of role and text; repeated rows: later ones are duplicates. Empty texts are
blank. Conversations without a row after damage: zeros, empty audit, digest of the empty string. Empty tables: no rows.
Other columns of the input are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from pricetide.operators.position import with_position
from pricetide.session import stage

# Turns of a chunk.
CHUNK = 65_536
# Characters that make no text.
BLANK = " \t\n\x0b\x0c\r"
# Roles as classes of their initial, and faults.
S, U, A = 1, 2, 3
BLANK_ROW, DUPLICATE, TRUNCATED = 1, 2, 3
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. Where an inserted or a re-roled turn leads from each, and its role.
NEXT = (2, 2, 3, 2)
GIVEN = ("user", "user", "assistant", "user")
KEEP = ({S: 1, U: 2}, {U: 2}, {A: 3}, {U: 2})
LEGAL = ((S, U), (U, A), (A, U))
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
# Costs behind the last turn, and what has to be inserted there.
END = (0, 2 * INSERT, INSERT, 0)
TRAILING = ("", "II", "I", "")

Vector = tuple[int, int, int, int]


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that each row's key asks for."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return (
        conversations.where(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_again"),
        )
        .drop("_again")
    )


# --- one chunk ---------------------------------------------------------------------------------


class Costs:
    """Steps of the cost vector. Vectors are kept with 0 as their least entry; few differ, so each step is made once."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, Vector], tuple[Vector, int]] = {}
        self.traced: dict[tuple[int, Vector, int], tuple[str, int]] = {}

    @staticmethod
    def _options(code: int, after: Vector, q: int) -> list[tuple[int, str, int]]:
        """Cost, letter and next state of the edits that use up a turn."""
        fault, role = code >> 2, code & 3
        out = [(DELETE + after[q], "D", q)]
        if fault not in (BLANK_ROW, DUPLICATE):
            extra = CUT_OFF if fault == TRUNCATED else 0
            if role in KEEP[q]:
                out.append((extra + after[KEEP[q][role]], "K", KEEP[q][role]))
            out.append((REROLE + extra + after[NEXT[q]], "R", NEXT[q]))
        return out

    @classmethod
    def _before(cls, code: int, after: Vector) -> list[int]:
        costs = [min(cls._options(code, after, q))[0] for q in range(4)]
        for _ in range(2):
            costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
        return costs

    def step(self, code: int, after: Vector) -> tuple[Vector, int]:
        """The vector before a turn, from the one behind it, and the constant taken off."""
        found = self.known.get((code, after))
        if found is None:
            costs = self._before(code, after)
            least = min(costs)
            found = self.known[code, after] = (tuple(c - least for c in costs), least)
        return found

    def back(self, codes: list[int], end: Vector) -> tuple[list[Vector], Vector, int]:
        """The vectors behind each turn, the one before the first turn, and the sum of the constants."""
        behind, now, shift = [END] * len(codes), end, 0
        for i in range(len(codes) - 1, -1, -1):
            behind[i] = now
            now, least = self.step(codes[i], now)
            shift += least
        return behind, now, shift

    def again(self, codes: list[int], behind: list[Vector], start: Vector, shift: int, end: Vector) -> tuple[Vector, int]:
        """Run back from another end vector until the kept one is met; ``behind`` is changed in place."""
        now = end
        for i in range(len(codes) - 1, -1, -1):
            if behind[i] == now:
                return start, shift
            shift -= self.step(codes[i], behind[i])[1]
            behind[i] = now
            now, least = self.step(codes[i], now)
            shift += least
        return now, shift

    def trace(self, codes: list[int], behind: list[Vector], q: int) -> tuple[str, int]:
        """The least letters of a chunk that is entered in state ``q``, and the state at its end."""
        letters = []
        for code, after in zip(codes, behind, strict=True):
            found = self.traced.get((code, after, q))
            if found is None:
                found = self.traced[code, after, q] = self._edits(code, after, q)
            letters.append(found[0])
            q = found[1]
        return "".join(letters), q

    @classmethod
    def _edits(cls, code: int, after: Vector, q: int) -> tuple[str, int]:
        """Inserted turns before a turn, then its own edit."""
        costs, letters = cls._before(code, after), ""
        while True:
            options = [*cls._options(code, after, q), (INSERT + costs[NEXT[q]], "I", NEXT[q])]
            _, letter, q = min((o for o in options if o[0] == costs[q]), key=lambda o: o[1])
            letters += letter
            if letter != "I":
                return letters, q


def _packed(vectors: list[Vector]) -> bytes:
    return np.array(vectors, np.int8).tobytes()


def _unpacked(packed: bytes) -> list[Vector]:
    return [tuple(v) for v in np.frombuffer(packed, np.int8).reshape(-1, 4).tolist()]


def _illegal(codes: list[int]) -> int:
    roles = [c & 3 for c in codes]
    return sum(pair not in LEGAL for pair in zip(roles, roles[1:], strict=False))


def _arrow(function, schema: pa.Schema):
    """Rows of a batch through ``function`` (a row to a row), batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for batch in batches:
            rows = [function(costs, row) for row in batch.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


_CHUNK_COLUMNS = "conv_id long, chunk long, final boolean, codes array<tinyint>"
_COST_COLUMNS = f"{_CHUNK_COLUMNS}, behind binary, end binary, start binary, shift long, illegal long"
_COSTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("chunk", pa.int64()), ("final", pa.bool_()), ("codes", pa.list_(pa.int8())),
        ("behind", pa.binary()), ("end", pa.binary()), ("start", pa.binary()), ("shift", pa.int64()), ("illegal", pa.int64()),
    ]
)


def _speculate(costs: Costs, row: dict) -> dict:
    behind, start, shift = costs.back(row["codes"], END)
    found = {"behind": _packed(behind), "end": _packed([END]), "start": _packed([start]), "shift": shift}
    return {**row, **found, "illegal": _illegal(row["codes"])}


def _mend(costs: Costs, row: dict) -> dict:
    wanted = row.pop("wanted")
    if wanted is None or wanted == row["end"]:
        return row
    behind = _unpacked(row["behind"])
    start, shift = costs.again(row["codes"], behind, _unpacked(row["start"])[0], row["shift"], _unpacked(wanted)[0])
    return {**row, "behind": _packed(behind), "end": wanted, "start": _packed([start]), "shift": shift}


def _map(costs: Costs, row: dict) -> dict:
    behind = _unpacked(row["behind"])
    return {"conv_id": row["conv_id"], "chunk": row["chunk"], "map": [costs.trace(row["codes"], behind, q)[1] for q in range(4)]}


def _audit(costs: Costs, row: dict) -> dict:
    letters, q = costs.trace(row["codes"], _unpacked(row["behind"]), row["entered"])
    if row["final"]:
        letters += TRAILING[q]
    return {"conv_id": row["conv_id"], "chunk": row["chunk"], "entered": row["entered"], "letters": letters}


_MAP = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("map", pa.list_(pa.int32()))])
_AUDIT = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("entered", pa.int32()), ("letters", pa.string())])


# --- all chunks --------------------------------------------------------------------------------


def _coded(rows: DataFrame, chunk: int) -> DataFrame:
    """``conv_id, turn, idx, n_total, fault, code``: fault and role class of every placed row, without its text."""
    text = F.rtrim("text", F.lit(BLANK))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(0)
    cut = ~F.right(text, F.lit(1)).isin(".", "!", "?")
    seen = rows.select("conv_id", "turn", "idx", "n_total", "_digest", role.alias("role"), (text == "").alias("blank"), cut.alias("cut"))
    # Partly counted before the shuffle, so a line that is repeated any number of times sends one row per task.
    first = seen.where(~F.col("blank")).groupBy("conv_id", "_digest").agg(F.min("idx").alias("idx"))
    first = first.select(F.col("conv_id").alias("_c"), F.col("idx").alias("_i"))
    met = seen.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("idx") == F.col("_i")), "left")
    fault = F.when(F.col("blank"), BLANK_ROW).when(F.col("_i").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(0)
    return met.select(
        "conv_id", "turn", "idx", "n_total", fault.alias("fault"), (fault * 4 + F.col("role")).cast("tinyint").alias("code")
    )


def _chunks(coded: DataFrame, chunk: int) -> DataFrame:
    at = F.floor((F.col("idx") - 1) / F.lit(chunk))
    listed = F.sort_array(F.collect_list(F.struct("idx", "code")))
    return (
        coded.groupBy("conv_id", at.alias("chunk"))
        .agg(listed.alias("_all"), F.max("n_total").alias("_n"))
        .select(
            "conv_id",
            "chunk",
            (F.col("chunk") == F.floor((F.col("_n") - 1) / F.lit(chunk))).alias("final"),
            F.transform("_all", lambda x: x["code"]).alias("codes"),
        )
    )


def _in_order() -> WindowSpec:
    return Window.partitionBy("conv_id").orderBy("chunk")


def _converged(costs: DataFrame) -> DataFrame:
    """Fix-up passes over the chunks of conversations that have several."""
    while True:
        seen = costs.withColumn("wanted", F.lead("start").over(_in_order()))
        if seen.where("wanted IS NOT NULL AND wanted != end").isEmpty():
            return costs
        costs = stage(seen.mapInArrow(_arrow(_mend, _COSTS), _COST_COLUMNS), "repair-costs")


def _entered(costs: DataFrame) -> DataFrame:
    """Adds ``entered``, the state in which each chunk is entered."""
    maps = stage(costs.mapInArrow(_arrow(_map, _MAP), "conv_id long, chunk long, map array<int>"), "repair-maps")
    far, span = maps.agg(F.max("chunk")).first()[0], 1
    while span <= far:
        before = F.lag("map", span).over(_in_order())
        joined = F.transform("before", lambda q: F.element_at("map", q + 1))
        maps = maps.withColumn("before", before).withColumn("map", F.coalesce(joined, "map")).drop("before")
        span *= 2
    state = F.coalesce(F.element_at(F.lag("map").over(_in_order()), 1), F.lit(0))
    states = maps.select(F.col("conv_id").alias("_c"), F.col("chunk").alias("_k"), state.alias("entered"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("chunk") == F.col("_k"))
    return costs.join(states, same).drop("_c", "_k")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the repaired lines of each conversation, from rows in order: a chunk's letters, then its turns."""
    held: dict = {}

    def say(line: str) -> None:
        held["sha"].update(("\n" if held["any"] else "").encode() + line.encode("utf-8", "surrogatepass"))
        held["any"] = True

    def inserted() -> None:
        while held["letters"].startswith("I", held["at"]):
            say(f"{GIVEN[held['q']]}:")
            held["q"], held["at"] = NEXT[held["q"]], held["at"] + 1

    def closed() -> list[dict]:
        if not held:
            return []
        inserted()
        return [{"conv_id": held["conv"], "repaired_sha256": held["sha"].hexdigest()}]

    def turn(role: str, text: str) -> None:
        inserted()
        letter, q = held["letters"][held["at"]], held["q"]
        held["at"] += 1
        if letter == "K":
            say(f"{role}:{text}")
            held["q"] = KEEP[q][{"s": S, "u": U, "a": A}[role[:1]]]
        elif letter == "R":
            say(f"{GIVEN[q]}:{text}")
            held["q"] = NEXT[q]

    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["letters"] is None:
                turn(row["role"], row["text"])
                continue
            if not held or held["conv"] != row["conv_id"]:
                done += closed()
                held.update(conv=row["conv_id"], sha=hashlib.sha256(), any=False)
            else:
                inserted()
            held.update(letters=row["letters"], at=0, q=row["entered"])
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if held:
        yield pa.RecordBatch.from_pylist(closed(), schema)


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Faults, the least cost, its letters and the digest of the repaired lines, per conversation of damaged rows.

    ``conversations``: ``conv_id, turn, role, text``, none of the last two null.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = with_position(rows.withColumn("_digest", digest), ["turn", "role", "_digest"], ["conv_id"])
    coded = stage(_coded(rows, chunk), "repair-codes")
    costs = stage(_chunks(coded, chunk).mapInArrow(_arrow(_speculate, _COSTS), _COST_COLUMNS), "repair-costs")
    whole = costs.where("chunk = 0 AND final").withColumn("entered", F.lit(0))
    several = costs.where("NOT (chunk = 0 AND final)")
    traced = whole
    if not several.isEmpty():
        several = _converged(several)
        # A border between chunks is a pair of turns too.
        border = F.array((F.element_at("codes", -1) % 4).cast("int"), (F.lead(F.col("codes")[0]).over(_in_order()) % 4).cast("int"))
        legal = F.array_contains(F.array(*[F.array(*map(F.lit, pair)) for pair in LEGAL]), border)
        several = several.withColumn("illegal", F.col("illegal") + F.when(~F.col("final") & ~legal, 1).otherwise(0))
        traced = whole.unionByName(_entered(several))
    traced = stage(traced, "repair-traced")
    letters = stage(
        traced.select("conv_id", "chunk", "final", "codes", "behind", "entered").mapInArrow(
            _arrow(_audit, _AUDIT), "conv_id long, chunk long, entered int, letters string"
        ),
        "repair-letters",
    )

    first = (F.col("chunk") * F.lit(chunk) + 1).alias("idx")
    nothing = F.lit(None).cast("string")
    headers = letters.select("conv_id", first, "letters", "entered", nothing.alias("role"), nothing.alias("text"))
    turns = rows.select("conv_id", "idx", nothing.alias("letters"), F.lit(None).cast("int").alias("entered"), "role", "text")
    lines = headers.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "idx", F.col("letters").isNull())
    digests = lines.mapInArrow(_digests, "conv_id long, repaired_sha256 string")

    counts = coded.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == k).alias(name) for k, name in ((BLANK_ROW, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))],
    )
    entry = F.when(F.col("chunk") == 0, F.expr("cast(conv(hex(substring(start, 1, 1)), 16, 10) as long)")).otherwise(0)
    costs = traced.groupBy("conv_id").agg(F.sum(F.col("shift") + entry).alias("cost"), F.sum("illegal").alias("illegal"))
    # One string a conversation is what is asked for; its pieces are put in order by chunk.
    pieces = F.sort_array(F.collect_list(F.struct("chunk", "letters")))
    audits = letters.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda x: x["letters"]), "").alias("audit"))
    # Put together by grouping, which takes a null id as equal to itself.
    found = counts
    for more in (costs, audits, digests):
        found = found.unionByName(more, allowMissingColumns=True)
    values = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return found.groupBy("conv_id").agg(*[F.max(v).alias(v) for v in values])


def repaired(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every ``conv_id`` that the undamaged ones have."""
    found = repair(damage(conversations), chunk).unionByName(conversations.select("conv_id").distinct(), allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return found.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )
