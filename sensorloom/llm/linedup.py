"""Line dedup by a segment-partition edit join.

Two lines within ``k`` edits of each other must share one of ``k + 1`` segments of the shorter one,
so each distinct line is indexed under its segments and probes the lengths and offsets at which a
partner's segment could stand in it. All of that is dealt and sorted by key once, and lines that meet
under a key are first compared by a parity mask that ``k`` edits cannot change by more than ``2 k`` bits,
then verified by banded bit-parallel edit distance.

Keys that few lines share give pairs. Keys that many share, as lines made from one template do, give none:
their lines are dealt in blocks, every two blocks of a key are compared in a task of their own, and a task
returns how many partners each line has there and at most one link per line, enough to keep what is
connected together. A pair is counted under the first segment that it shares, so no key counts it twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from sensorloom.llm.common import SLICE, join_spread, whole, word_count
from sensorloom.llm.components import components
from sensorloom.llm.shingles import Powers, mixed
from sensorloom.operators.ordering import spread_join
from sensorloom.session import written

#: Most edits between near lines, and code points of the shorter line for each edit allowed.
EDITS = 2
CHARS_PER_EDIT = 10
#: Code points handled at a time; a longer line is handled alone.
CHUNK = 1 << 18
#: Candidate lines up to which their hashes are broadcast (8 MB); beyond it they are joined by shuffle.
BROADCAST_LINES = 1_000_000
#: Rows of a key up to which its lines are paired one by one; beyond it they are compared in blocks.
PAIRED = 64
#: Lines and bytes of a block.
BLOCK_LINES, BLOCK_BYTES = 1024, 8 << 20
#: Places of one line beyond which they are spread over tasks.
BUSY_PLACES = 50_000
_SPACE = " \t\n\x0b\x0c\r"
_MASK = (1 << 32) - 1  # the low bits of a short hash are the parity mask of its line
_PAD = np.uint32(0xFFFFFFFF)  # no code point
_SEGMENT = 7  # low bits of a role: the segment; above them 0 for an indexed line, else 1 and how much longer it is


def _chunks(lines: Sequence[str]) -> Iterator[Sequence[str]]:
    at, size = 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= CHUNK:
            yield lines[at : i + 1]
            at, size = i + 1, 0
    if at < len(lines):
        yield lines[at:]


def _prefixes(lines: Sequence[str], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the joined lines, their running hash, and each line's start and length."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return points, powers.prefix(points.astype(np.uint64) + np.uint64(1)), starts, lengths


def nodes_of(lines: Sequence[str], powers: Powers) -> np.ndarray:
    """A short hash of each line: 32 bits of its text, and the parity of its code points in 32 classes.

    Lines meet by it; which lines are equal is told by :func:`node_of`.
    """
    out = []
    for part in _chunks(lines):
        points, sums, starts, lengths = _prefixes(part, powers)
        text = mixed((sums[starts + lengths] - sums[starts]) * powers.down[starts] + lengths.astype(np.uint64))
        bits = np.uint32(1) << (points & np.uint32(31))  # each letter of an alphabet has a class of its own
        odd = np.zeros(len(part), np.uint32)
        some = lengths > 0
        if some.any():
            odd[some] = np.bitwise_xor.reduceat(bits, starts[some])
        out.append((text << np.uint64(32)) | odd.astype(np.uint64))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def node_of(line: str) -> bytes:
    """128 bits that stand for a line."""
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def segment(lengths: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment ``i`` of lines of these lengths cut evenly into ``edits + 1``; the last ones are longer."""
    base, rest = lengths // (edits + 1), lengths % (edits + 1)
    longer = np.maximum(0, i - (edits + 1 - rest))
    return i * base + longer, base + (i >= edits + 1 - rest)


def offsets(i: int, shorter: int, edits: int) -> range:
    """Where segment ``i`` of a line can stand in one longer by ``shorter``, as shifts from its own place.

    With ``i`` segments to the left free of matches so far and ``edits - i`` to the right, more shift
    on either side would cost more edits than are left.
    """
    return range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1)


def _roles(probe: bool, edits: int) -> Iterator[tuple[int, int, int, int]]:
    """(segment, how much shorter the partner is, shift, role): all ways in which a line is indexed, or looks."""
    for shorter in range(edits + 1) if probe else (0,):
        for i in range(edits + 1):
            for shift in offsets(i, shorter, edits) if probe else (0,):
                yield i, shorter, shift, (1 + shorter if probe else 0) * (_SEGMENT + 1) + i


def _keys(lines: Sequence[str], nodes: np.ndarray, roles: Sequence[tuple[int, int, int, int]], edits: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(key, node, role) of lines in these roles."""
    made, at = [], 0
    for part in _chunks(lines):
        _, sums, starts, lengths = _prefixes(part, powers)
        own = nodes[at : at + len(part)]
        at += len(part)
        for i, shorter, shift, role in roles:
            other = lengths - shorter
            place, size = segment(other, i, edits)
            fits = (other >= CHARS_PER_EDIT) & (place + shift >= 0) & (place + shift + size <= lengths)
            begin = (starts + place + shift)[fits]
            text = (sums[begin + size[fits]] - sums[begin]) * powers.down[begin]
            key = mixed(mixed(text + np.uint64(i + 1)) + other[fits].astype(np.uint64))
            made.append((key.view(np.int64), own[fits], np.full(len(key), role, np.int8)))
    if not made:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)
    return tuple(np.concatenate(x) for x in zip(*made))


def join_keys(lines: Sequence[str], nodes: np.ndarray, probe: bool, edits: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) under which lines are indexed, or with ``probe`` the keys with which they look."""
    return _keys(lines, nodes, [*_roles(probe, edits)], edits, powers)[:2]


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits between ``a`` and ``b`` if at most ``most``, else ``most + 1``.

    One machine word per number of errors holds the band of ``2 most + 1`` diagonals: bit ``j`` of
    ``reach[d]`` says that, with ``d`` errors, the part of ``a`` read so far goes with the part of
    ``b`` that is ``j - most`` longer.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    head, n = 0, min(len(a), len(b))
    while head < n and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    band = (1 << (2 * most + 1)) - 1
    reach = [((1 << (d + 1)) - 1) << most & band for d in range(most + 1)]
    for i, c in enumerate(a):
        equal = 0
        for j in range(max(0, most - i), min(2 * most + 1, len(b) - i + most)):
            if b[i + j - most] == c:
                equal |= 1 << j
        before, reach[0] = reach[0], reach[0] & equal
        for d in range(1, most + 1):
            own = reach[d]
            # read both alike; read both, replaced; skip one of a; skip one of b
            reach[d] = own & equal | before | before >> 1 | reach[d - 1] << 1 & band
            before = own
        if not reach[most]:
            return most + 1
    end = 1 << (len(b) - len(a) + most)
    return next((d for d in range(most + 1) if reach[d] & end), most + 1)


def edits_allowed(a: str, b: str, edits: int) -> int:
    return min(edits, min(len(a), len(b)) // CHARS_PER_EDIT)


def first_shared(a: str, b: str, edits: int) -> int:
    """The first segment of ``a``, no longer than ``b``, that stands in ``b`` where it may; ``edits + 1`` if none does."""
    for i in range(edits + 1):
        (place,), (size,) = segment(np.array([len(a)]), i, edits)
        for shift in offsets(i, len(b) - len(a), edits):
            if 0 <= place + shift and b.startswith(a[place : place + size], place + shift) and place + shift + size <= len(b):
                return i
    return edits + 1


class Lanes:
    """Lines side by side, for comparing one line with all of them at once."""

    def __init__(self, lines: Sequence[str]):
        self.lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        width = int(self.lengths.max(initial=0))
        self.points = np.full((len(lines), width + 1), _PAD, np.uint32)
        filled = np.arange(width + 1) < self.lengths[:, None]
        self.points[filled] = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.back = np.full_like(self.points, _PAD)
        self.back[filled] = np.frombuffer("".join(line[::-1] for line in lines).encode("utf-32-le", "surrogatepass"), np.uint32)

    @staticmethod
    def _alike(points: np.ndarray, rows: np.ndarray, line: np.ndarray) -> np.ndarray:
        """How many characters these rows and ``line`` have in common from the first on."""
        same = points[rows, : len(line)] == line[: points.shape[1]]
        return np.where(same.all(1), same.shape[1], same.argmin(1))

    def distances(self, line: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
        """Edits between ``line`` and these rows, up to ``most``, else ``most + 1``: :func:`edit_distance` lane by lane."""
        out = np.full(len(rows), most + 1)
        here = np.abs(self.lengths[rows] - len(line)) <= most
        at, rows = np.flatnonzero(here), rows[here]
        if not len(rows):
            return out
        n, sizes = len(line), self.lengths[rows]
        head = self._alike(self.points, rows, line)
        tail = np.minimum(self._alike(self.back, rows, line[::-1]), np.minimum(n, sizes) - head)
        end, end_b = n - tail, sizes - tail
        band = (1 << (2 * most + 1)) - 1
        reach = [np.full(len(rows), ((1 << (d + 1)) - 1) << most & band) for d in range(most + 1)]
        live, step = np.arange(len(rows)), 0
        while True:
            live = live[(head[live] + step < end[live]) & (reach[most][live] != 0)]
            if not len(live):
                break
            i = head[live] + step
            equal = np.zeros(len(live), np.int64)
            for j in range(2 * most + 1):
                other = i + j - most
                stands = (other >= head[live]) & (other < end_b[live])
                equal |= (stands & (self.points[rows[live], np.where(stands, other, 0)] == line[i])).astype(np.int64) << j
            before = reach[0][live]
            reach[0][live] = before & equal
            for d in range(1, most + 1):
                own = reach[d][live]
                reach[d][live] = own & equal | before | before >> 1 | reach[d - 1][live] << 1 & band
                before = own
            step += 1
        found = np.full(len(rows), most + 1)
        for d in range(most, -1, -1):
            found[(reach[d] >> (end_b - end + most)) & 1 == 1] = d
        out[at] = found
        return out

    def share(self, line: np.ndarray, rows: np.ndarray, before: int, edits: int) -> np.ndarray:
        """Which rows share a segment of ``line`` before segment ``before`` with it; no row is shorter."""
        out = np.zeros(len(rows), bool)
        for i in range(before):
            (place,), (size,) = segment(np.array([len(line)]), i, edits)
            for longer in range(edits + 1):
                of = np.flatnonzero(self.lengths[rows] == len(line) + longer)
                for shift in offsets(i, longer, edits):
                    begin = place + shift
                    if len(of) and begin >= 0 and begin + size <= len(line) + longer:
                        out[of] |= (self.points[rows[of], begin : begin + size] == line[place : place + size]).all(1)
        return out


def block_partners(left: pa.Table, right: pa.Table, edits: int, every: bool = False) -> pa.Table:
    """Compare a block of indexed lines with a block of lines of the same key.

    Gives ``(node, null, partners)`` for each line's number of near partners whose first shared segment is the
    key's, and links ``(a, b, distance)``: of all such pairs with ``every``, else so few that they have no ring.
    """
    links: list[tuple] = []
    partners: dict[bytes, int] = {}
    if left.num_rows and right.num_rows:
        lanes = Lanes(right["line"].to_pylist())
        nodes, short = right["node"].to_pylist(), right["node_short"].to_numpy()
        counts, part_of, place_of = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), {node: i for i, node in enumerate(nodes)}
        for line, node, own, segment_no in zip(*(left[c].to_pylist() for c in ("line", "node", "node_short", "segment"))):
            most, points = min(edits, len(line) // CHARS_PER_EDIT), np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
            longer = lanes.lengths - len(line)
            after = (longer > 0) | (short > own)
            for tie in np.flatnonzero((longer == 0) & (short == own)):
                after[tie] = nodes[tie] > node
            rows = np.flatnonzero(after & (longer >= 0) & (longer <= most) & (np.bitwise_count((short ^ own) & _MASK) <= 2 * edits))
            far = lanes.distances(points, rows, most)
            rows, far = rows[far <= most], far[far <= most]
            first = ~lanes.share(points, rows, segment_no, edits)
            rows, far = rows[first], far[first]
            if not len(rows):
                continue
            counts[rows] += 1
            partners[node] = len(rows)
            told = np.arange(len(rows))
            if not every:
                # One link into each part that these partners make up so far; then all are one part.
                parts, told = np.unique(part_of[rows], return_index=True)
                mine = part_of[place_of[node]] if node in place_of else parts[0]
                if node in place_of:
                    told = told[parts != mine]
                part_of[np.isin(part_of, parts)] = mine
            links += [(node, nodes[r], d) for r, d in zip(rows[told].tolist(), far[told].tolist())]
        for place in np.flatnonzero(counts):
            partners[nodes[place]] = partners.get(nodes[place], 0) + int(counts[place])
    rows = links if every else links + [(node, None, n) for node, n in partners.items()]
    kinds = (pa.binary(), pa.binary(), pa.int64())
    return pa.table([pa.array(values, kind) for values, kind in zip(zip(*rows) if rows else ([], [], []), kinds)], ["a", "b", "n"])


def _lines(docs: DataFrame, with_text: bool) -> DataFrame:
    """A row per line with a word: its ``doc_id``, number from 0 and ``node``, or with its text ``node``, ``short`` and the text."""
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("hash", LongType()), StructField("line_no", IntegerType())]
    node = StructField("node", BinaryType())
    kind = StructType([node, StructField("short", LongType()), StructField("line", StringType())] if with_text else [*fields, node])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                lines, rows, numbers = [], [], []
                for row, text in enumerate(part.column(2).to_pylist()):
                    for number, line in enumerate(text.split("\n")):
                        if line.strip(_SPACE):
                            lines.append(line)
                            rows.append(row)
                            numbers.append(number)
                nodes = pa.array(map(node_of, lines), pa.binary())
                if with_text:
                    yield pa.RecordBatch.from_arrays([nodes, pa.array(nodes_of(lines, powers)), pa.array(lines, pa.string())], kind.names)
                else:
                    taken = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(taken), part.column(1).take(taken), pa.array(numbers, pa.int32()), nodes], kind.names)

    return docs.select("doc_id", F.xxhash64(whole()).alias("_hash"), whole().alias("_text")).mapInArrow(split, kind)


def _keyed(lines: DataFrame, edits: int) -> DataFrame:
    """(key, node, role) of distinct lines (short, line), as indexed and as looking."""
    # A line that looks where it is indexed itself meets no more lines than those indexed there.
    roles = [*_roles(False, edits), *(r for r in _roles(True, edits) if r[1] or r[2])]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * SLICE):
                part = batch.slice(at, 4 * SLICE)
                made = _keys(part.column(1).to_pylist(), part.column(0).to_numpy(), roles, edits, powers)
                yield pa.RecordBatch.from_arrays([*map(pa.array, made)], ["key", "node", "role"])

    return lines.select("short", "line").mapInArrow(make, "key bigint, node bigint, role tinyint")


def _pairs(key: np.ndarray, node: np.ndarray, role: np.ndarray, edits: int) -> tuple[np.ndarray, ...]:
    """(indexed line, other line, segment) of whole runs of keys, sorted by key and role."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
    found, left, apart = [], np.arange(len(key)), 1
    while True:
        left = left[left + apart < len(key)]
        left = left[(run[left] == run[left + apart]) & (role[left] <= _SEGMENT)]
        if not len(left):
            break
        a, b, other = node[left], node[left + apart], role[left + apart]
        alike = np.bitwise_count((a ^ b) & _MASK) <= 2 * edits
        # Of lines of equal length the lesser is the indexed one; of two indexed ones either can be.
        both = other <= _SEGMENT
        fits = alike & (both | (other > 2 * _SEGMENT + 1) | (a <= b))
        a, b, both = a[fits], b[fits], both[fits]
        found.append((np.where(both, np.minimum(a, b), a), np.where(both, np.maximum(a, b), b), role[left[fits]] & _SEGMENT))
        apart += 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (node[:0], node[:0], role[:0])


def _meetings(keyed: DataFrame, edits: int) -> DataFrame:
    """Pairs ``(null, a, b, segment)``, and lines of keys with more than ``PAIRED`` rows as ``(key, node, null, role)``."""
    kind, names = "key bigint, a bigint, b bigint, role tinyint", ["key", "a", "b", "role"]
    paired = PAIRED

    def out(key, a, b, role) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none if key is None else pa.array(key), pa.array(a), none if b is None else pa.array(b), pa.array(role)], names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8))
        passing = None  # the key whose rows are being passed on
        for batch in _and_last(batches):
            rows = held if batch is None else tuple(np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held))
            key, node, role = rows
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(starts, len(key)))
            # A run without an indexed line, which would come first, has no pairs.
            known = (key[starts] == passing) if passing is not None else np.zeros(len(starts), bool)
            many = (sizes > paired) & (role[starts] <= _SEGMENT) | known
            useful = (sizes > 1) & (role[starts] <= _SEGMENT)
            rest = np.zeros(len(starts), bool)
            if batch is not None and len(starts):
                rest[-1] = not many[-1]  # the last run may go on
                passing = key[-1] if many[-1] else None
            if many.any():
                taken = np.repeat(many, sizes)
                yield out(key[taken], node[taken], None, role[taken])
            taken = np.repeat(useful & ~many & ~rest, sizes)
            a, b, segment_no = _pairs(key[taken], node[taken], role[taken], edits)
            if len(a):
                yield out(None, a, b, segment_no)
            # Of a long run without an indexed line one row is enough to know it by.
            taken = np.repeat(rest, sizes)
            held = tuple(x[taken] if useful[-1:].any() else x[taken][:1] for x in rows)

    return keyed.repartition("key").sortWithinPartitions("key", "role").mapInArrow(meet, kind)


def _and_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_lines(lines: DataFrame, edits: int = EDITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(links, partners, every)`` of different lines of ``lines`` (node, short, line) that are near.

    Near means at most ``edits`` edits, and one for every ``CHARS_PER_EDIT`` code points of the shorter line.
    ``links`` (a, b) connect all lines that a chain of near lines connects; ``partners`` (node, n) says how
    many lines each one is near, in several rows; ``every`` (a, b, distance) are all pairs, which are not worked out before
    they are read: a key of many near lines makes many of them.
    """
    distinct = lines.groupBy("node").agg(F.first("short").alias("short"), F.first("line").alias("line"))
    met = written(_meetings(_keyed(distinct, edits), edits), "line-meetings")
    pairs = met.filter("key is null").groupBy("a", "b").agg(F.min("role").alias("segment"))
    crowded = met.filter("key is not null").groupBy("key", F.col("a").alias("node")).agg(
        F.min(F.col("role").bitwiseAND(F.lit(_SEGMENT))).alias("segment"), F.min("role").alias("role"))
    crowded = crowded.select("key", "node", "segment", (F.col("role") <= _SEGMENT).alias("indexed"))

    wanted = met.select(F.col("a").alias("short")).unionAll(met.select("b").filter("b is not null")).distinct()
    wanted = written(wanted, "line-nodes")
    small = wanted.count() <= BROADCAST_LINES
    bodies = lines.join(F.broadcast(wanted) if small else wanted, "short", "left_semi")
    bodies = written(bodies.groupBy("node").agg(F.first("short").alias("short"), F.first("line").alias("line")), "line-texts")
    first = bodies.select(F.col("short").alias("a"), F.col("node").alias("_a"), F.col("line").alias("_x"))
    second = bodies.select(F.col("short").alias("b"), F.col("node").alias("_b"), F.col("line").alias("_y"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "_a", "_b", "_x", "_y", "segment")]
            for row, (a, b, own, other, x, y, segment_no) in enumerate(zip(*columns)):
                # Two lines can have one short hash: then any two of them may stand here.
                if len(x) > len(y) or (len(x) == len(y) and (a, own) >= (b, other)):
                    continue
                most = edits_allowed(x, y, edits)
                distance = edit_distance(x, y, most)
                if distance <= most and first_shared(x, y, edits) == segment_no:
                    kept.append(row)
                    found.append(distance)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_a").take(rows), batch.column("_b").take(rows), pa.array(found, pa.int64())], ["a", "b", "n"])

    kind = "a binary, b binary, n bigint"
    joined = pairs.join(first, "a").join(second, "b").mapInArrow(verify, kind)

    texts = crowded.join(bodies.select(F.col("short").alias("node"), F.col("node").alias("own"), "line"), "node")
    texts = written(texts.select("key", F.col("own").alias("node"), F.col("node").alias("node_short"), "line", "segment", "indexed"), "crowded-lines")
    size = F.greatest(F.ceil(F.count("*") / BLOCK_LINES), F.least(F.count("*"), F.ceil(F.sum(F.length("line").cast("bigint") * 4) / BLOCK_BYTES))).cast("int")
    blocks = written(texts.groupBy("key").agg(size.alias("blocks")).select(F.col("key").alias("_key"), "blocks"), "crowded-keys")
    placed = spread_join(texts, blocks, F.col("key") == F.col("_key"), "inner", ["node"]).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["key", "node", "node_short", "line", "segment"]
    left = placed.filter("indexed").withColumn("_other", other).select(*columns, F.col("_own").alias("_left"), F.col("_other").alias("_right"))
    # As columns of their own: both sides come from one table.
    right = placed.withColumn("_other", other).select(*[F.col(c).alias(c) for c in columns], F.col("_other").alias("_left"), F.col("_own").alias("_right"))
    meet = ["key", "_left", "_right"]

    def compared(every: bool) -> DataFrame:
        return left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(lambda x, y: block_partners(x, y, edits, every), kind)

    paired, counted = written(joined, "line-links"), written(compared(False), "crowded-links")
    links = paired.select("a", "b").unionByName(counted.filter("b is not null").select("a", "b"))
    ends = paired.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("bigint").alias("n"))
    partners = ends.unionByName(counted.filter("b is null").select(F.col("a").alias("node"), "n"))
    every = paired.unionByName(compared(True)).select("a", "b", F.col("n").cast("int").alias("distance"))
    return links, partners, every


def near_duplicate_lines(docs: DataFrame, edits: int = EDITS, busy_places: int = BUSY_PLACES) -> tuple[DataFrame, DataFrame]:
    """Every line with a word and its class, and the links between different lines.

    The first frame has ``doc_id``, ``hash`` (of the document's text), ``line_no`` (from 0), ``node``
    (128 bits of the line), ``first_doc`` and ``first_line`` (the class's first line, by doc_id and number),
    ``n_links`` (other lines near this one; equal lines are one) and ``kept`` (whether it is the first). The second has
    ``a``, ``b`` (nodes) and ``distance`` of all near pairs, which are worked out only when it is read.

    A null text counts as empty and has no lines; nor have blank lines a row. Lines under
    ``CHARS_PER_EDIT`` code points are only near if equal. A null ``doc_id`` comes last. Rows equal in
    ``doc_id`` and text share their lines' decisions. Very long texts and lines are taken whole; lines are compared
    within the edits allowed however long they are. An empty table gives no rows. Other columns are ignored. The places
    of a line that stands more than ``busy_places`` times are not gathered in one task.
    """
    links, partners, every = near_lines(_lines(docs, True), edits)
    places = written(_lines(docs, False), "line-places")
    linked = components(links).join(partners.groupBy("node").agg(F.sum("n").alias("n_links")), "node")
    place = F.struct(F.col("doc_id").isNull().alias("nobody"), "doc_id", "line_no")
    nodes = places.groupBy("node").agg(F.min(place).alias("_at"), F.count("*").alias("_places")).join(linked, "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    heads = nodes.groupBy("root").agg(F.min("_at").alias("_first"))
    decided = nodes.join(heads, "root").select(
        F.col("node").alias("_node"), F.col("_first.doc_id").alias("first_doc"), F.col("_first.line_no").alias("first_line"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "_places",
    )
    decided = written(decided, "line-classes")
    found = join_spread(places, decided, "node", "_places", busy_places, ["doc_id", "line_no"])
    kept = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("line_no") == F.col("first_line"))
    return found.select("doc_id", "hash", "line_no", "node", "first_doc", "first_line", "n_links", kept.alias("kept")), every


def drop_repeated_lines(docs: DataFrame, least_words: int = 5, edits: int = EDITS, least_left: int = 20) -> DataFrame:
    """``docs`` without the lines of ``least_words`` or more words that are near an earlier line.

    Shorter lines repeat by chance and stay. ``n_chars``, if there is one, is counted anew. Documents
    that lost lines and have less than ``least_left`` percent of their words left go; all others stay,
    with all their columns.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    lines, _ = near_duplicate_lines(docs, edits)
    gone = lines.filter(~F.col("kept")).distinct().groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).agg(F.collect_set("line_no").alias("_gone"))
    same = doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hash"))

    def stays(line, number):
        return ~F.array_contains("_gone", number) | (word_count(line) < least_words)

    left = F.array_join(F.filter(F.split(text, "\n"), stays), "\n")
    joined = rows.join(gone, same, "left").withColumn("_text", F.when(F.col("_gone").isNull(), text).otherwise(left))
    joined = joined.filter(F.col("_gone").isNull() | (100 * word_count(F.col("_text")) >= least_left * word_count(text)))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_gone").isNull(), F.col(names[docs.columns.index("n_chars")])).otherwise(F.length("_text"))
    first = {docs.columns.index(c): value.cast(docs.schema[c].dataType) for c, value in new.items()}
    return joined.select(*[first.get(i, F.col(n)).alias(n) for i, n in enumerate(names)]).toDF(*docs.columns)
