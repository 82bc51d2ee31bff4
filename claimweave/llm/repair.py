"""Conversation structure repair by parallel Viterbi with rank convergence.

A conversation should be an optional system turn and then pairs of a user and an
assistant turn.  Each turn is kept, given another role, or deleted, and empty turns may
be put in anywhere; the cheapest edits that make it so are found by cost vectors that
run backwards over the turns, one cost for each of the four states a reader can be in.

Turns are sorted over the whole cluster and cut into chunks, so a conversation of any
length is spread over tasks.  For the search a turn is one byte.  Every chunk starts
from a speculative vector at its right end, the one that is true at the end of a
conversation.  Fix-up passes then rerun a chunk from each vector that reaches it from
the right and that it has not met, up to a constant; they end when all vectors that
arrive differ from known ones by constants only.  What every chunk found is stitched:
from the right to settle which vector is true, from the left to settle the state in
which it is entered.  Then all chunks trace their edits at once, by costs to go.

Turns that must go are no step of the search: they cost the same in every state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.llm.base import saved, slices

CHUNK_ROWS, CHUNK_BYTES, BLOCK_BYTES = 1 << 16, 1 << 20, 4 << 20

# costs of edits, and of a truncated turn that stays
KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 3, 4, 3, 3
# a turn as a byte: 4 * class of the role's initial + fault
CLASSES, FAULTS = "sua", ("", "truncated", "blank", "duplicate")
# states: nothing yet, after system, after user, after assistant; what an initial leads to
STEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
# the role that a state asks for, and where it leads
NEEDED, AFTER = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
COMPLETE = (0, 3)
LEGAL = {(0, 1), (1, 2), (2, 1)}

Vector = tuple[int, int, int, int]
# to end well: nothing, or a user and an assistant turn, or an assistant turn
FINAL: Vector = (0, 2 * INSERT, INSERT, 0)


def stay(fault: int) -> int:
    return TRUNCATED_STAYS if fault == 1 else 0


class Costs:
    """One backward step and one forward choice, remembered: vectors are kept up to a constant, so few occur."""

    def __init__(self) -> None:
        self.back: dict = {}
        self.forth: dict = {}

    def before(self, symbol: int, after: Vector) -> Vector:
        """Costs to go before a turn, from those after it, less those of the last state."""
        known = self.back.get((symbol, after))
        if known is None:
            kind, fault = divmod(symbol, 4)
            own = []
            for state in range(4):
                ways = [DELETE + after[state], REROLE + stay(fault) + after[AFTER[state]]]
                if kind in STEP[state]:
                    ways.append(KEEP + stay(fault) + after[STEP[state][kind]])
                own.append(min(ways))
            # one or two turns put in before it
            one = [min(own[s], INSERT + own[AFTER[s]]) for s in range(4)]
            all_ways = [min(one[s], INSERT + one[AFTER[s]]) for s in range(4)]
            known = tuple(c - all_ways[3] for c in all_ways), all_ways[3]
            self.back[symbol, after] = known
        return known[0]

    def choice(self, symbol: int, after: Vector, state: int) -> tuple[str, int]:
        """The ASCII-least cheapest edits up to and with a turn, and the state after it."""
        known = self.forth.get((symbol, after, state))
        if known is None:
            vector, base = self.before(symbol, after), self.back[symbol, after][1]
            kind, fault = divmod(symbol, 4)
            letters, at, done = "", state, False
            while not done:
                to_go = vector[at] + base
                if to_go == DELETE + after[at]:
                    letters, done = letters + "D", True
                elif to_go == INSERT + vector[AFTER[at]] + base:
                    letters, at = letters + "I", AFTER[at]
                elif kind in STEP[at] and to_go == KEEP + stay(fault) + after[STEP[at][kind]]:
                    letters, at, done = letters + "K", STEP[at][kind], True
                else:
                    letters, at, done = letters + "R", AFTER[at], True
            known = self.forth[symbol, after, state] = letters, at
        return known

    def run(self, symbols: bytes, end: Vector) -> tuple[Vector, list[Vector]]:
        """The vector before a chunk, and those after each turn in it."""
        after = [end] * len(symbols)
        for k in range(len(symbols) - 1, -1, -1):
            after[k] = end
            if symbols[k] & 3 < 2:
                end = self.before(symbols[k], end)
        return end, after

    def trace(self, symbols: bytes, after: list[Vector], state: int) -> tuple[list[str], int]:
        """The edits that go with each turn, and the state after the chunk."""
        out = []
        for symbol, vector in zip(symbols, after, strict=True):
            letters = "D"
            if symbol & 3 < 2:
                letters, state = self.choice(symbol, vector, state)
            out.append(letters)
        return out, state

    def ending(self, state: int) -> str:
        """What is put in after the last turn."""
        letters = ""
        while state not in COMPLETE:
            letters, state = letters + "I", AFTER[state]
        return letters


def edited(symbols: bytes, edits: list[str], state: int, roles: list[str], texts: list[str]) -> tuple[int, list[str], list[str]]:
    """Cost, roles and texts of a chunk after its edits; further edits than turns are inserts."""
    cost, out_roles, out_texts = 0, [], []
    for k, letters in enumerate(edits):
        for letter in letters:
            if letter == "D":
                cost += DELETE
                continue
            kept = letter == "K"
            cost += (KEEP if kept else INSERT if letter == "I" else REROLE) + (0 if letter == "I" else stay(symbols[k] & 3))
            out_roles.append(roles[k] if kept else NEEDED[state])
            out_texts.append("" if letter == "I" else texts[k])
            state = STEP[state][symbols[k] >> 2] if kept else AFTER[state]
    return cost, out_roles, out_texts


def conversation_key(conv_id: Column) -> Column:
    """A string that tells conversations apart, NULL among them."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("null"))


CHUNK = "conv string, part int, k int, symbols binary, digests binary, roles array<string>, texts array<string>"


def chunked(turns: DataFrame, chunk_rows: int, parts: int | None) -> DataFrame:
    """Runs of turns of one conversation in order, ``chunk_rows`` or about a megabyte at most.

    (part, k) ascends along a conversation.  Order is turn (NULL first), role, digest of
    role and text; copies, which are alike, are dealt out by a number.  Within a part
    repeats are already marked as duplicates.
    """
    initial = F.substring("role", 1, 1)
    kind = F.lit(len(CLASSES))
    for k, letter in enumerate(CLASSES):
        kind = F.when(initial == letter, k).otherwise(kind)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(blank, 2).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 0).otherwise(1)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = turns.select("conv_id", conversation_key(F.col("conv_id")).alias("conv"), "turn", "role", "text")
    rows = rows.withColumns({"symbol": (4 * kind + fault).cast("int"), "digest": digest, "copy": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "digest", "copy"]
    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        done, held = [], 0
        conv, k, seen = None, 0, set()
        symbols, digests, roles, texts, size = bytearray(), bytearray(), [], [], 0

        def close() -> None:
            done.append((conv, part, k, bytes(symbols), bytes(digests), list(roles), list(texts)))
            for x in (symbols, digests, roles, texts):
                x.clear()

        for batch in slices(batches, "text", BLOCK_BYTES):
            for own, symbol, digest, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if symbols and (own != conv or len(symbols) >= chunk_rows or size >= CHUNK_BYTES):
                    close()
                    k, held, size = k + 1, held + size, 0
                if own != conv:
                    conv, k, seen = own, 0, set()
                if symbol & 3 < 2:
                    if digest in seen:
                        symbol |= 3
                    seen.add(digest)
                symbols.append(symbol)
                digests += digest
                roles.append(role)
                texts.append(text)
                size += len(text)
            if held > BLOCK_BYTES or len(done) > 4096:
                yield rows_of(done, CHUNK_ARROW)
                done, held = [], 0
        if symbols:
            close()
        if done:
            yield rows_of(done, CHUNK_ARROW)

    ordered = ranged.sortWithinPartitions(*order).select("conv", "symbol", "digest", "role", "text")
    return ordered.mapInArrow(cut, CHUNK)


CHUNK_ARROW = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("k", pa.int32()), ("symbols", pa.binary()), ("digests", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


PLACE = ["conv", "part", "k"]


def without_repeats(parts: DataFrame) -> DataFrame:
    """(conv, part, k, symbols) of the chunks of conversations that have several, repeats across parts marked."""

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("conv", pa.string()), ("digest", pa.binary()), ("part", pa.int32()), ("k", pa.int32()), ("at", pa.int32())])
        for batch in batches:
            for conv, part, k, symbols, digests in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = [(conv, digests[16 * i : 16 * i + 16], part, k, i) for i, s in enumerate(symbols) if s & 3 < 2]
                yield rows_of(rows, kind)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for symbols, places in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                own = bytearray(symbols)
                for at in places or ():
                    own[at] |= 3
                out.append(bytes(own))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=[*PLACE, "symbols"])

    each = parts.select(*PLACE, "symbols", "digests").mapInArrow(turns, "conv string, digest binary, part int, k int, at int")
    place = F.struct("part", "k", "at")
    firsts = each.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = each.join(firsts, ["conv", "digest"]).filter(place != F.col("first"))
    places = later.groupBy(*PLACE).agg(F.collect_list("at").alias("places"))  # a chunk's turns at most
    return parts.select(*PLACE, "symbols").join(places, PLACE, "left").select(*PLACE, "symbols", "places").mapInArrow(mark, "conv string, part int, k int, symbols binary")


def written(vector: Iterable[int]) -> str:
    return ",".join(map(str, vector))


def read(vector: str) -> Vector:
    return tuple(map(int, vector.split(",")))


RUNS = "conv string, part int, k int, start string, end string, exits string"


def rerun(chunks: DataFrame) -> DataFrame:
    """(conv, part, k, start, end, exits) of chunks with a vector ``start`` after them: the vector before, and the state that each state leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for batch in batches:
            ends, exits = [], []
            for symbols, start in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                end, after = costs.run(symbols, read(start))
                ends.append(written(end))
                exits.append(written(costs.trace(symbols, after, s)[1] for s in range(4)))
            out = [*batch.columns[:3], batch.column(4), pa.array(ends, pa.string()), pa.array(exits, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=[*PLACE, "start", "end", "exits"])

    return chunks.select(*PLACE, "symbols", "start").mapInArrow(run, RUNS)


def converged(chunks: DataFrame) -> DataFrame:
    """Runs of every chunk from its speculative vector and from all that reach it from the right."""
    runs = saved(rerun(chunks.withColumn("start", F.lit(written(FINAL)))), "repair-runs")
    along = W.partitionBy("conv").orderBy("part", "k")
    left = saved(chunks.select(*PLACE, F.lag(F.struct("part", "k")).over(along).alias("to")).filter("to IS NOT NULL"), "repair-left")
    new = runs
    while True:
        arriving = new.join(left, PLACE).select("conv", "to.part", "to.k", F.col("end").alias("start")).distinct()
        unmet = saved(arriving.join(runs, [*PLACE, "start"], "left_anti"), "repair-unmet")
        if unmet.isEmpty():
            return runs
        new = saved(rerun(chunks.join(unmet, PLACE)), "repair-runs")
        runs = runs.unionByName(new)


def stitched(runs: DataFrame) -> DataFrame:
    """(conv, part, k, start, entry, last): the true vector after each chunk, and the state it is entered in.

    A conversation's runs, some for each chunk, stream through one task, which holds one at a time.
    """

    def leftwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, vector = None, None, None
        for batch in batches:
            keep, last = [], []
            for i, (c, part, k, start, end) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(5)), strict=True)):
                if c != conv:
                    conv, place, vector = c, None, written(FINAL)
                if (part, k) != place and start == vector:
                    keep.append(i)
                    last.append(place is None)
                    place, vector = (part, k), end
            taken = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column(j) for j in (0, 1, 2, 3, 5)] + [pa.array(last, pa.bool_())], names=[*PLACE, "start", "exits", "last"])

    def rightwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, 0
        for batch in batches:
            entries = []
            for c, exits in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if c != conv:
                    conv, state = c, 0
                entries.append(state)
                state = int(exits.split(",")[state])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(entries, pa.int32()), batch.column(5)], names=[*PLACE, "start", "entry", "last"])

    back = runs.repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("k"), "start")
    true = back.mapInArrow(leftwards, "conv string, part int, k int, start string, exits string, last boolean")
    ahead = true.repartition("conv").sortWithinPartitions(*PLACE)
    return ahead.mapInArrow(rightwards, "conv string, part int, k int, start string, entry int, last boolean")


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
PIECE = f"conv string, part int, k int, whole boolean, {', '.join(f'{c} long' for c in COUNTS)}, opens int, closes int, audit string, sha256 string, roles array<string>, texts array<string>"
PIECE_ARROW = pa.schema(
    [("conv", pa.string()), ("part", pa.int32()), ("k", pa.int32()), ("whole", pa.bool_())]
    + [(c, pa.int64()) for c in COUNTS]
    + [("opens", pa.int32()), ("closes", pa.int32()), ("audit", pa.string()), ("sha256", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)


def traced(chunks: DataFrame, with_turns: bool) -> DataFrame:
    """What becomes of each chunk; repaired turns only where asked for or where the conversation has more chunks."""

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for batch in batches:
            out, held = [], 0
            for conv, part, k, symbols, roles, texts, start, entry, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                whole = start is None
                vector, state = (FINAL, 0) if whole else (read(start), entry)
                edits, end = costs.trace(symbols, costs.run(symbols, vector)[1], state)
                if whole or last:
                    edits = [*edits, costs.ending(end)]
                cost, new_roles, new_texts = edited(symbols, edits, state, roles, texts)
                faults = [symbols.translate(FAULT_OF).count(f) for f in (2, 3, 1)]
                kinds = [s >> 2 for s in symbols]
                illegal = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:], strict=False))
                digest = hashlib.sha256(joined(new_roles, new_texts)).hexdigest() if whole else None
                shown = with_turns or not whole
                out.append((conv, part, k, whole, *faults, illegal, cost, kinds[0], kinds[-1], "".join(edits), digest, new_roles if shown else None, new_texts if shown else None))
                held += sum(map(len, new_texts)) if shown else 0
                if held > BLOCK_BYTES:
                    yield rows_of(out, PIECE_ARROW)
                    out, held = [], 0
            yield rows_of(out, PIECE_ARROW)

    return chunks.select(*PLACE, "symbols", "roles", "texts", "start", "entry", "last").mapInArrow(trace, PIECE)


FAULT_OF = bytes(k & 3 for k in range(256))


def joined(roles: list[str], texts: list[str]) -> bytes:
    return "\n".join(f"{r}:{t}" for r, t in zip(roles, texts, strict=True)).encode()


def repaired(turns: DataFrame, with_turns: bool = True, chunk_rows: int = CHUNK_ROWS, parts: int | None = None) -> DataFrame:
    """Pieces of repaired conversations, in the order of (part, k) within a conversation ``conv`` (see ``conversation_key``).

    ``turns`` has conv_id, turn, role and text; no role or text may be NULL.  whole says
    that a piece is all of its conversation.  A role's first character is its initial;
    an empty role, like any other than s, u and a, fits nowhere.
    """
    chunks = saved(chunked(turns, chunk_rows, parts), "repair-chunks")
    split = chunks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv")
    several = saved(without_repeats(chunks.join(split, "conv", "left_semi")), "repair-symbols")
    if several.isEmpty():
        none = F.lit(None)
        return traced(chunks.withColumns({"start": none.cast("string"), "entry": none.cast("int"), "last": none.cast("boolean")}), with_turns)
    settled = several.join(stitched(converged(several)), PLACE).withColumnRenamed("symbols", "marked")
    full = chunks.join(settled, PLACE, "left").withColumn("symbols", F.coalesce("marked", "symbols"))
    return traced(full, with_turns)


def repaired_turns(turns: DataFrame, **how) -> DataFrame:
    """(conv, part, k, at, role, text): repaired conversations, turn by turn in this order."""
    pieces = repaired(turns, **how)
    each = pieces.select(*PLACE, F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "turn"))
    return each.select(*PLACE, "at", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


def summed(pieces: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and digest of the repaired turns.

    Conversations of several pieces stream through one task each, in order, as a digest
    of the whole text asks for; the task holds one piece and the edits so far.
    """
    columns = ["conv", *COUNTS, "audit", "sha256"]
    kind = f"conv string, {', '.join(f'{c} long' for c in COUNTS)}, audit string, sha256 string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.string()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("sha256", pa.string())])
        conv, counts, edge, edits, digest, empty = None, None, None, None, None, True
        for batch in batches:
            done = []
            for own, *numbers, opens, closes, audit, roles, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != conv:
                    if conv is not None:
                        done.append((conv, *counts, "".join(edits), digest.hexdigest()))
                    conv, counts, edits, digest, empty = own, numbers, [audit], hashlib.sha256(), True
                else:
                    counts = [a + b for a, b in zip(counts, numbers, strict=True)]
                    counts[COUNTS.index("illegal")] += (edge, opens) not in LEGAL
                    edits.append(audit)
                if roles:
                    digest.update(b"" if empty else b"\n")
                    digest.update(joined(roles, texts))
                    empty = False
                edge = closes
            yield rows_of(done, schema)
        if conv is not None:
            yield rows_of([(conv, *counts, "".join(edits), digest.hexdigest())], schema)

    whole = pieces.filter("whole").select(*columns)
    ordered = pieces.filter("NOT whole").repartition("conv").sortWithinPartitions(*PLACE)
    return whole.unionByName(ordered.select("conv", *COUNTS, "opens", "closes", "audit", "roles", "texts").mapInArrow(join, kind))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, way: turns harmed by a hash of conv_id and turn; a dropped turn keeps its row, with way 0."""
    space = F.lit(" ")
    name = lambda c: F.coalesce(F.col(c).cast("string"), space)
    way = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), way.alias("way"))
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "way")


def repair_report(conversations: DataFrame, **how) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation, after damage.

    NULL role and text, and NULL parts of the damaged key, are one space.  Rows without a
    conv_id are one conversation.  Turns are taken by turn, NULL first; rows of one turn by
    role, then by a digest of role and text, so copies are adjacent.  A conversation that
    lost all its rows has zeros, no audit and the digest of an empty string.  No rows: no rows.
    """
    rows = damaged(conversations)
    twice = F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    turns = rows.filter("way <> 0").select("conv_id", "turn", "role", "text", twice.alias("_copy")).drop("_copy")
    pieces = saved(repaired(turns, with_turns=False, **how), "repair-pieces")
    left = F.when(F.col("way") != 0, F.col("turn"))
    spans = rows.select("conv_id", left.alias("turn")).groupBy("conv_id")
    spans = spans.agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")).withColumn("conv", conversation_key(F.col("conv_id")))
    full = spans.join(summed(pieces), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    digest = F.coalesce("sha256", F.sha2(F.lit(""), 256))
    return full.select("conv_id", *map(zero, ["gaps", *COUNTS]), F.coalesce("audit", F.lit("")).alias("audit"), digest.alias("repaired_sha256"))
