"""Structure repair of conversations by a parallel Viterbi search.

A conversation should read ``(s?(ua)+)?`` in initials of its roles. Four states say what has been read: nothing,
a system turn, a user turn, an assistant turn. A row is kept, given another role or deleted, and empty turns are
put in; each costs something, and a min-plus product of one 4 x 4 matrix a row gives the cheapest way.

Rows are numbered within their conversation and dealt in chunks. A chunk runs backwards from a cost vector for the
state behind it: the true one at the end of a conversation, a speculative one elsewhere. Fix-up passes then give
every chunk the vector that its successor came to, and run it again until its vector differs from the one before
only by a constant, from where on nothing changes. This ends soon, as costs of ordinary turns forget what comes
after them. Where they don't (say a role that no state accepts, over and over), the chunks still open after
:data:`PASSES` are settled exactly by products of chunk matrices, in runs of bounded length over bounded levels.
The stitched vectors then drive the forward trace, which takes the least letter that stays on a cheapest way, so
the audit is the least of all cheapest ones.

A conversation of any length is thus spread over tasks by its chunks. Only :func:`digests` reads one in order, as a
digest of one sequence must: streamed, in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import Scratch
from boxframe.operators.ranking import HOT_ROWS, grouped_row_number

#: Rows of a chunk.
CHUNK = 64
#: Fix-up passes before what is still open is settled by matrices.
PASSES = 6
#: Chunks, or runs of them, whose product one task forms.
RUN = 1024

# Costs of the edits, and the state after the role that a state waits for.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
FILL = np.array([2, 2, 3, 2])
ROLES = ("user", "assistant")
GAPS = r"[^\x20\x09-\x0D]"
STOPS = r"[.!?]"

#: Large enough to never be on a cheapest way, small enough to add up.
_NO = 1 << 40
# Codes of a row: class of its initial (s, u, a, other) + 4 if its text breaks off + 8 if it must go; padding.
_TRUNCATED, _GONE, _PAD = 4, 8, 16
_KEPT = np.full((17, 4), -1)
for _code in range(8):
    for _state in range(4):
        _KEPT[_code, _state] = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (1, 3): 2, (2, 2): 3}.get((_code % 4, _state), -1)


def _matrices() -> np.ndarray:
    """For each code, the least cost from a state before the row, where turns may be put in, to one after it."""
    fill = np.full((4, 4), _NO)
    for s in range(4):
        t, cost = s, 0
        for _ in range(4):
            fill[s, t] = min(fill[s, t], cost)
            t, cost = FILL[t], cost + INSERT
    out = np.full((17, 4, 4), _NO)
    for code in range(16):
        row = np.full((4, 4), _NO)
        for s in range(4):
            row[s, s] = DELETE
            if code < _GONE:
                late = UNFINISHED * (code >= _TRUNCATED)
                row[s, FILL[s]] = min(row[s, FILL[s]], REROLE + late)
                if _KEPT[code, s] >= 0:
                    row[s, _KEPT[code, s]] = min(row[s, _KEPT[code, s]], late)
        out[code] = (fill[:, :, None] + row[None]).min(1)
    out[_PAD] = np.where(np.eye(4, dtype=bool), 0, _NO)
    return np.minimum(out, _NO)


STEPS = _matrices()
#: Costs from each state to the end of a conversation, and the speculative vector.
END = np.array([0, 4, 2, 0])
CARRIED = ["conv", "chunk", "chunks", "codes", "peek"]


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch for batch in batches if batch.num_rows)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of codes as bytes."""
    for batch in _filled(batches):
        column = batch.column("listed")
        flat, ends = column.flatten().to_numpy().astype(np.uint8), np.cumsum(column.value_lengths().to_numpy())
        codes = [flat[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()) if c == "codes" else batch.column(c) for c in CARRIED], names=CARRIED)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of stacks of matrices."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), _NO)


def _padded(column: pa.Array, unit: int = 1, fill: int = _PAD, width: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A binary column as rows of bytes, set right, and their lengths in units."""
    values = [np.frombuffer(v.as_py(), np.uint8) for v in column]
    lengths = np.array([len(v) // unit for v in values], int)
    out = np.full((len(values), max(width, int(lengths.max(initial=0))) * unit), fill, np.uint8)
    for row, v in zip(out, values, strict=True):
        row[len(row) - len(v) :] = v
    return out, lengths


def backward(codes: np.ndarray, ends: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
    """Cost vectors (less their minimum) before each row and behind the last, for rows of padded codes.

    With ``known`` vectors of another end, a row stops as soon as its vector is the known one: the costs differ by a
    constant there, and so do all before.
    """
    n, width = codes.shape
    out = np.zeros((n, width + 1, 4), np.uint8) if known is None else known.copy()
    vectors = ends - ends.min(1, keepdims=True)
    going = np.arange(n) if known is None else np.flatnonzero((out[:, width] != vectors).any(1))
    out[:, width] = vectors
    for i in range(width - 1, -1, -1):
        vectors = (STEPS[codes[going, i]] + out[going, None, i + 1]).min(2)
        vectors -= vectors.min(1, keepdims=True)
        if known is not None:
            moved = (out[going, i] != vectors).any(1)
            going, vectors = going[moved], vectors[moved]
            if not len(going):
                break
        out[going, i] = vectors
    return out


def trace(codes: np.ndarray, vectors: np.ndarray, entry: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Least audit of each chunk from its entry state. ``last``: nothing follows the chunk.

    Gives, for each letter, its code (0 behind the end), the row it stands at and the role it sets (1 user, 2
    assistant, else 0), and the state that each chunk comes to.
    """
    n, width = codes.shape
    state, rows, at = entry.copy(), np.arange(n), np.zeros(n, int)
    letters, places, roles = (np.zeros((n, 2 * width + 3), np.int16) for _ in range(3))

    def put(which: np.ndarray, letter: str, place: int) -> None:
        letters[which, at[which]] = ord(letter)
        places[which, at[which]] = place
        if letter in "IR":
            state[which] = FILL[state[which]]
            roles[which, at[which]] = state[which] - 1
        at[which] += 1

    for i in range(width):
        code = codes[:, i]
        after, late = vectors[:, i + 1].astype(int), UNFINISHED * ((code >= _TRUNCATED) & (code < _GONE))
        least = (STEPS[code] + after[:, None]).min(2)
        left = np.flatnonzero(code != _PAD)
        while len(left):
            rest = least[left, state[left]]
            gone = DELETE + after[left, state[left]] == rest
            filled = ~gone & (INSERT + least[left, FILL[state[left]]] == rest)
            to = _KEPT[code[left], state[left]]
            kept = ~gone & ~filled & (to >= 0) & (late[left] + after[left, to] == rest)
            other = ~gone & ~filled & ~kept
            put(left[gone], "D", i)
            put(left[kept], "K", i)
            state[left[kept]] = to[kept]
            put(left[other], "R", i)
            put(left[filled], "I", i)
            left = left[filled]
    left = rows[last]
    while len(left := left[END[state[left]] > 0]):
        put(left, "I", width)
    return letters, places, roles, state


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that a hash of ``conv_id:turn`` decides; ``copy`` numbers a row and its repeat."""
    key = F.concat_ws(":", _blank("conv_id"), _blank("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text"))
    filled = conversations.select("conv_id", "turn", _blank("role").alias("role"), _blank("text").alias("text"))
    rows = filled.filter(kind != 0)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(0), F.when(kind == 3, 1).otherwise(0))).alias("copy"),
    )


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _placed(rows: DataFrame, hot_rows: int) -> DataFrame:
    """Rows with ``conv`` and ``place``, their number (from 0) in the conversation."""
    named = rows.select(_blank("conv_id").alias("conv"), "turn", _blank("role").alias("role"), _blank("text").alias("text"), "copy")
    # Coarser and coarser cuts of the order, for conversations and turns with very many rows.
    levels = [F.col("turn").isNotNull(), F.coalesce(F.floor(F.col("turn") / 65536), F.lit(0)), F.coalesce("turn", F.lit(0)), F.col("role"), F.substring("text", 1, 24)]
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("copy")]
    return grouped_row_number(named, ["conv"], order, levels, "place", hot_rows).withColumn("place", F.col("place") - 1)


def _faults(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """``place`` and ``code`` with the first fault of each row."""
    firsts = scratch.table(placed.groupBy("conv", "role", "text").agg(F.min("place").alias("place")).select("conv", "place", F.lit(True).alias("new")), "firsts")
    marked = placed.join(firsts, ["conv", "place"], "left")
    blank = ~F.col("text").rlike(GAPS)
    unfinished = ~F.col("text").rlike(STOPS + r"[\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(F.col("new").isNull(), "duplicate").when(unfinished, "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    code = kind + F.when(fault == "truncated", _TRUNCATED).when(fault.isNotNull(), _GONE).otherwise(0)
    return marked.select("conv", "place", fault.alias("fault"), code.alias("code"))


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _filled(batches):
        codes, lengths = _padded(batch.column("codes"))
        yield _with_vectors(batch, backward(codes, np.tile(END, (len(codes), 1))), lengths)


def _with_vectors(batch: pa.RecordBatch, found: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    kept = [v[len(v) - k - 1 :].tobytes() for v, k in zip(found, lengths, strict=True)]
    columns = [*[batch.column(c) for c in CARRIED], *[pa.array(v, pa.binary()) for v in (kept, [v[:4] for v in kept], [v[-4:] for v in kept])]]
    return pa.RecordBatch.from_arrays(columns, names=[*CARRIED, "vectors", "start", "end"])


def _known(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded codes with their lengths, and the stored vectors, padded likewise."""
    codes, lengths = _padded(batch.column("codes"))
    flat, _ = _padded(batch.column("vectors"), 4, 0, codes.shape[1] + 1)
    return codes, lengths, flat.reshape(len(codes), -1, 4)


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs chunks again whose ``true_end`` isn't the vector they started from."""
    for batch in _filled(batches):
        codes, lengths, known = _known(batch)
        ends = _padded(batch.column("true_end"))[0].reshape(-1, 4).astype(int)
        yield _with_vectors(batch, backward(codes, ends, known), lengths)


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrix of each chunk, as its place from the end needs it: transposed."""
    for batch in _filled(batches):
        codes, _ = _padded(batch.column("codes"))
        whole = np.tile(STEPS[_PAD], (len(codes), 1, 1))
        for i in range(codes.shape[1]):
            whole = product(whole, STEPS[codes[:, i]])
        yield _elements(batch, whole.transpose(0, 2, 1), pc.subtract(pc.subtract(batch.column("chunks"), batch.column("chunk")), 1))


def _elements(batch: pa.RecordBatch, matrices: np.ndarray, place: pa.Array) -> pa.RecordBatch:
    values = pa.ListArray.from_arrays(pa.array(np.arange(len(matrices) + 1, dtype=np.int32) * 16), pa.array(matrices.reshape(-1).astype(np.int64)))
    return pa.RecordBatch.from_arrays([batch.column("conv"), place, values], names=["conv", "place", "matrix"])


def carried(scratch: Scratch, elements: DataFrame, first: np.ndarray, run: int = RUN) -> DataFrame:
    """``conv``, ``place``, ``carry``: ``first`` times the matrices of all smaller places of the conversation.

    Elements (``conv``, ``place`` from 0 without gaps, ``matrix``) are multiplied in runs, the runs in runs of runs,
    and so on until one is left for each conversation; then carries go down again. No task sees more than ``run``
    elements of a conversation at a time.
    """
    levels = [scratch.table(elements, "elements")]
    numbered = F.floor(F.col("place") / run).cast("long")

    def multiplied(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        whole = STEPS[_PAD][None]
        for m in np.stack(part.column("matrix").to_numpy()).reshape(-1, 1, 4, 4):
            whole = product(whole, m)
        return pa.table({"conv": part.column("conv")[:1], "place": part.column("run")[:1], "matrix": pa.array([whole.reshape(-1)], pa.list_(pa.int64()))})

    def below(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        carry, out = np.array(part.column("above")[0].as_py()), []
        for m in np.stack(part.column("matrix").to_numpy()).reshape(-1, 4, 4):
            out.append(carry)
            carry = np.minimum((carry[:, None] + m).min(0), _NO)
        return pa.table({"conv": part.column("conv"), "place": part.column("place"), "carry": pa.array(out, pa.list_(pa.int64()))})

    while levels[-1].agg(F.max("place")).first()[0] or 0:
        upper = levels[-1].withColumn("run", numbered).groupBy("conv", "run").applyInArrow(multiplied, "conv string, place bigint, matrix array<bigint>")
        levels.append(scratch.table(upper, "runs"))
    carry = levels[-1].select("conv", "place", F.array(*[F.lit(int(v)) for v in first]).cast("array<bigint>").alias("carry"))
    for level in reversed(levels[:-1]):
        above = carry.select("conv", F.col("place").alias("run"), F.col("carry").alias("above"))
        joined = level.withColumn("run", numbered).join(above, ["conv", "run"])
        carry = scratch.table(joined.groupBy("conv", "run").applyInArrow(below, "conv string, place bigint, carry array<bigint>"), "carry")
    return carry


def _settled(chunks: DataFrame, scratch: Scratch, passes: int, run: int) -> DataFrame:
    """Chunks of conversations that have several, with true vectors."""
    shape = chunks.schema

    def with_true_ends(df: DataFrame) -> DataFrame:
        after = df.select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("start").alias("next"))
        end = F.when(F.col("chunk") == F.col("chunks") - 1, F.col("end")).otherwise(F.col("next"))
        return df.join(after, ["conv", "chunk"], "left").withColumn("true_end", end).drop("next")

    for _ in range(passes):
        linked = scratch.table(with_true_ends(chunks), "linked")
        if linked.filter("end <> true_end").isEmpty():
            return chunks
        chunks = scratch.table(linked.mapInArrow(_fix_up, shape), "chunks")
    linked = with_true_ends(chunks)
    still = scratch.table(linked.filter("end <> true_end").select("conv").distinct(), "still")
    if still.isEmpty():
        return chunks
    open_ = chunks.join(still, "conv", "left_semi")
    ends = carried(scratch, open_.mapInArrow(_multiplied, "conv string, place bigint, matrix array<bigint>"), END, run)

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _filled(batches):
            codes, lengths = _padded(batch.column("codes"))
            ends = np.array(batch.column("carry").to_pylist()).reshape(-1, 4)
            yield _with_vectors(batch, backward(codes, ends), lengths)

    named = ends.select("conv", F.col("place").alias("behind"), "carry")
    exact = open_.withColumn("behind", F.col("chunks") - 1 - F.col("chunk")).join(named, ["conv", "behind"]).mapInArrow(as_bytes, shape)
    return scratch.table(chunks.join(still, "conv", "left_anti").unionByName(exact), "settled")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each entry state the state a chunk comes to, as a matrix of free and impossible ways."""
    for batch in _filled(batches):
        codes, _, vectors = _known(batch)
        n = len(codes)
        ways = np.full((n, 4, 4), _NO)
        for s in range(4):
            ways[np.arange(n), s, trace(codes, vectors, np.full(n, s), np.zeros(n, bool))[3]] = 0
        yield _elements(batch, ways, batch.column("chunk"))


def _edits(batches: Iterator[pa.RecordBatch], chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """A row for each letter of the audit, and one (``step`` -1) with cost and illegal pairs of the chunk."""
    for batch in _filled(batches):
        codes, lengths, vectors = _known(batch)
        n, width = codes.shape
        chunk, entry, peek = (batch.column(c).to_numpy(zero_copy_only=False).astype(int) for c in ("chunk", "entry", "peek"))
        letters, places, roles, _ = trace(codes, vectors, entry, chunk + 1 == batch.column("chunks").to_numpy())
        row, step = np.nonzero(letters)
        letter, place = letters[row, step], places[row, step]
        code = np.pad(codes, ((0, 0), (0, 1)), constant_values=_PAD)[row, place]
        late = UNFINISHED * ((code >= _TRUNCATED) & (code < _GONE))
        price = np.select([letter == ord(c) for c in "DIR"], [DELETE, INSERT, REROLE + late], late)
        kinds = np.where(np.hstack([codes, peek[:, None]]) == _PAD, -1, np.hstack([codes, peek[:, None]]) % 4)
        a, b = kinds[:, :-1], kinds[:, 1:]
        fine = (a == 0) & (b == 1) | (a == 1) & (b == 2) | (a == 2) & (b == 1)
        illegal = (~fine & (a >= 0) & (b >= 0)).sum(1)
        first = chunk * chunk_rows
        at = pa.array(np.concatenate([row, np.arange(n)]))
        nothing = np.zeros(len(row), np.int64)
        names = np.array([None, *ROLES], object)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv").take(at),
                pa.array(np.concatenate([(first - width + lengths)[row] + place, first])),
                pa.array(np.concatenate([step, np.full(n, -1)]).astype(np.int32)),
                pa.array([*map(chr, letter), *[None] * n], pa.string()),
                pa.array([*names[roles[row, step]], *[None] * n], pa.string()),
                pa.array(np.concatenate([nothing, np.bincount(row, price, n).astype(np.int64)])),
                pa.array(np.concatenate([nothing, illegal])),
            ],
            names=["conv", "place", "step", "edit", "set_role", "cost", "illegal"],
        )


@dataclass
class Repair:
    """``rows``: repaired rows in order of ``conv``, ``place``, ``step``. ``audit``: a letter an edit, in the same order.
    ``summary``: one row for each original conversation. ``conv`` names a conversation, a null ID by one space."""

    rows: DataFrame
    audit: DataFrame
    summary: DataFrame


def repair(conversations: DataFrame, damaged: DataFrame | None = None, chunk: int = CHUNK, passes: int = PASSES, run: int = RUN, hot_rows: int = HOT_ROWS) -> Repair:
    """Cheapest edits that make each conversation read ``(s?(ua)+)?``, the least audit of equally cheap ones.

    ``damaged`` are the rows to repair (``conv_id``, ``turn``, ``role``, ``text``, ``copy``), ``conversations`` those
    whose IDs the summary lists, with ``rows``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` and
    ``cost``. Nulls in role or text are one space. Rows go by turn, nulls first, those of one turn by role, text and
    copy; equal ones can't be told apart. A role counts by its first letter: any but s, u, a must be replaced or go,
    the empty one too. A conversation without rows has zeros and no repaired rows. Empty tables give empty ones.
    Extra columns are not read.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark)
    source = conversations.select(_blank("conv_id").alias("conv"), "conv_id", "turn", "role", "text")
    rows = source.withColumn("copy", F.lit(0)) if damaged is None else damaged
    placed = scratch.table(_placed(rows, hot_rows), "placed")
    coded = scratch.table(_faults(placed, scratch), "coded")
    at = F.floor(F.col("place") / chunk).cast("bigint")
    own = F.struct(at.alias("chunk"), (F.col("place") % chunk).cast("int").alias("i"), F.col("code").cast("tinyint").alias("code"))
    # The first row of a chunk is shown to the one before, for the pair that the two make.
    peek = F.struct((at - 1).alias("chunk"), F.lit(chunk).alias("i"), F.col("code").cast("tinyint").alias("code"))
    both = F.when((F.col("place") % chunk == 0) & (F.col("place") > 0), F.array(own, peek)).otherwise(F.array(own))
    in_order = F.sort_array(F.collect_list(F.struct("i", "code")))
    chunks = coded.select("conv", F.inline(both)).groupBy("conv", "chunk").agg(in_order.alias("held"))
    codes = F.filter("held", lambda x: x["i"] < chunk)["code"]
    last = F.element_at("held", -1)
    # Written, so that Spark can split the chunks of one long conversation in the join.
    sizes = scratch.table(coded.groupBy("conv").agg(F.ceil(F.count("*") / chunk).cast("bigint").alias("chunks")), "sizes")
    listed = chunks.join(sizes, "conv").select("conv", "chunk", "chunks", codes.alias("listed"), F.when(last["i"] == chunk, last["code"].cast("int")).otherwise(_PAD).alias("peek"))
    shape = "conv string, chunk bigint, chunks bigint, codes binary, peek int, vectors binary, start binary, end binary"
    first = scratch.table(listed.mapInArrow(_packed, "conv string, chunk bigint, chunks bigint, codes binary, peek int").mapInArrow(_first_pass, shape), "first")
    one = first.filter("chunks = 1").withColumn("entry", F.lit(0))
    several = _settled(first.filter("chunks > 1"), scratch, passes, run)
    start = np.array([0, _NO, _NO, _NO])
    entries = carried(scratch, several.mapInArrow(_exits, "conv string, place bigint, matrix array<bigint>"), start, run)
    entry = F.array_position("carry", F.lit(0).cast("bigint")).cast("int") - 1
    entered = several.join(entries.select("conv", F.col("place").alias("chunk"), entry.alias("entry")), ["conv", "chunk"])
    edits = scratch.table(
        one.unionByName(entered).mapInArrow(lambda b: _edits(b, chunk), "conv string, place bigint, step int, edit string, set_role string, cost bigint, illegal bigint"), "edits"
    )
    audit = edits.filter("step >= 0").select("conv", "place", "step", "edit", "set_role")
    # A place has one of these edits, so rows and edits meet one to one.
    text = placed.select("conv", "place", "role", "text")
    changed = audit.filter("edit in ('K', 'R')").join(text, ["conv", "place"]).withColumn("role", F.coalesce("set_role", "role"))
    put_in = audit.filter("edit = 'I'").withColumns({"role": F.col("set_role"), "text": F.lit("")})
    columns = ["conv", "place", "step", "edit", "role", "text"]
    return Repair(changed.select(columns).unionByName(put_in.select(columns)), audit, _summary(source, placed, coded, edits))


def _summary(source: DataFrame, placed: DataFrame, coded: DataFrame, edits: DataFrame) -> DataFrame:
    turns = placed.select("conv", "turn").groupBy("conv", "turn").agg(F.count("*").alias("n"))
    span = turns.groupBy("conv").agg(F.sum("n").alias("rows"), (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    names = ("blank", "duplicate", "truncated")
    faults = coded.groupBy("conv").agg(*[F.count_if(F.col("fault") == name).alias(name) for name in names])
    prices = edits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    every = source.groupBy("conv").agg(F.min("conv_id").alias("conv_id"))
    joined = every.join(span, "conv", "left").join(faults, "conv", "left").join(prices, "conv", "left")
    zero = F.lit(0).cast("bigint")
    counts = ["rows", "gaps", *names, "illegal", "cost"]
    return joined.select("conv", "conv_id", *[F.coalesce(F.col(c).cast("bigint"), zero).alias(c) for c in counts])


def digests(repaired: Repair) -> DataFrame:
    """``conv``, ``audit`` and ``sha256`` of the repaired ``role:text`` lines, for conversations with an edit.

    A task reads its conversations in order, a batch at a time, and holds a digest and an audit; so one
    conversation, however long, goes through one task without being gathered.
    """
    line = F.concat_ws(":", "role", "text")
    lines = repaired.rows.select("conv", "place", "step", "edit", line.alias("line"))
    gone = repaired.audit.filter("edit = 'D'").select("conv", "place", "step", "edit", F.lit(None).cast("string").alias("line"))
    ordered = lines.unionByName(gone).repartition("conv").sortWithinPartitions("conv", "place", "step")
    return ordered.mapInArrow(_streamed, "conv string, audit string, sha256 string")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("sha256", pa.string())])
    now, state, letters, empty, out = None, hashlib.sha256(), [], True, []
    for batch in batches:
        for conv, edit, line in zip(*[batch.column(c).to_pylist() for c in ("conv", "edit", "line")], strict=True):
            if conv != now:
                if now is not None:
                    out.append((now, "".join(letters), state.hexdigest()))
                now, state, letters, empty = conv, hashlib.sha256(), [], True
            letters.append(edit)
            if line is not None:
                state.update(line.encode() if empty else b"\n" + line.encode())
                empty = False
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)] or [pa.array([], pa.string())] * 3, schema=shape)
        out = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (now, "".join(letters), state.hexdigest())], schema=shape)
