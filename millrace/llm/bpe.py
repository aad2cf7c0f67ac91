"""Byte-level BPE encoding and decoding with DuckDB recursive queries.

A text is split by the vocabulary's pattern; each worker keeps the ids of the
pieces it has met and hands only new pieces to DuckDB.  There the pieces are
token-position rows; a recursive query joins neighbouring tokens with the merge
table and contracts each piece's leftmost pair of the smallest rank until no pair
can be merged.  Decoding joins ids with the vocabulary and aggregates the tokens'
bytes in order.

A piece is first cut where no token of the vocabulary can reach across
(:meth:`Codec._segments`), which changes no result.  Segments take as many rounds
as they have merges.  For those over ``SHORT`` bytes (a run of one letter, say) the
recursive query keeps one state, keyed by position, rather than one for each round,
and a round contracts all occurrences of the smallest pair, from left to right
without overlap, if no pair that can arise from the merged token has a smaller
rank: the next contractions would be just these.
"""

from __future__ import annotations

import base64
import contextlib
import threading
from collections.abc import Iterator
from itertools import batched

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import bound_batches, give_back

SHORT = 48  # bytes of a segment; its states of all rounds are SHORT / 2 times as many rows at most
CHUNK_BYTES = 200_000  # of pieces in one recursive query, or one longer segment
CHUNK_IDS = 200_000  # that are decoded at once
CHUNK_PIECES = 200_000  # of one text that are looked up at once
BLOCK_CHARS = 2_000_000  # of texts that are looked up at once
QUERY_MB, SEGMENT_BYTES = 256, 700  # DuckDB's memory: so much, or so many bytes for each byte of a very long segment
IDLE_SECONDS = 4
KEPT_BYTES = 160 << 20  # pieces that a worker remembers, with their ids, and as many older ones
_ENTRY_BYTES = 180  # what remembering a piece takes besides

_CONTRACT = """
with recursive state as (
    select 0::int as round, seg, pos, token from seed
    union all
    (with pairs as materialized (
        select t.round, t.seg, t.pos, t.token, t.previous, m.merged
        from (select *, lead(token) over w as following, lag(pos) over w as previous
              from state window w as (partition by seg order by pos)) t
        left join merges m on m.one = t.token and m.two = t.following),
    leftmost as (select seg, min((merged << 8) | pos) as best from pairs where merged is not null group by seg)
    select (round + 1)::int, seg, pos, case when pos = best & 255 then best >> 8 else token end
    from pairs join leftmost using (seg) where previous is distinct from best & 255))
select seg, list(token order by pos) as ids
from state semi join (select seg, max(round) as round from state group by seg) using (seg, round)
group by seg"""
_CONTRACT_LONG = """
with recursive state(seg, pos, token) using key (seg, pos) as (
    select seg, pos, token from seed
    union
    (with live as materialized (
        select *, lead(token) over w as following, lead(pos) over w as after, row_number() over w as place
        from recurring.state where token is not null and seg in (select seg from state)
        window w as (partition by seg order by pos)),
    least as (
        select live.*, merged, alone from live join merges on one = token and two = following
        qualify merged = min(merged) over (partition by seg)),
    runs as (select *, place - row_number() over (partition by seg order by pos) as run from least),
    steps as (select *, row_number() over (partition by seg, run order by pos) as step, row_number() over (partition by seg order by pos) as nth from runs),
    chosen as (select * from steps where step % 2 = 1 and (nth = 1 or not alone))
    select seg, pos, merged from chosen
    union all
    select seg, after, null from chosen))
select seg, list(token order by pos) as ids from state where token is not null group by seg"""
_JOIN = "select list(coalesce(token, ''::blob) order by pos) as tokens from given left join vocabulary using (id)"


class Codec:
    """The vocabulary in one DuckDB connection, with the ids of the pieces met so far."""

    def __init__(self, vocabulary: bytes, pattern: str, kept: int = KEPT_BYTES):
        self.kept = kept
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.split = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers
        self.older: dict[str, bytes] = {}  # known before, kept while still met
        self.held = 0  # bytes
        self.ready = False
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{QUERY_MB}MB", "temp_directory": ""})
        self._create("vocabulary", id=pa.array(self.ranks.values(), pa.int32()), token=pa.array(self.ranks.keys(), pa.binary()))

    def _create(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create table {name} as from given")
        self.db.unregister("given")

    def _prepare(self) -> None:
        """What encoding alone needs: the merge table, and which bytes can meet within a token."""
        found = []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left, right, rank))
        merges = np.array(found, np.int32).reshape(-1, 3)
        # tokens from which a pair with a smaller rank than their own can arise
        alone = np.unique(np.concatenate([merges[merges[:, i] > merges[:, 2], i] for i in (0, 1)]))
        self._create("merges", one=merges[:, 0], two=merges[:, 1], merged=merges[:, 2], alone=np.isin(merges[:, 2], alone))
        self.twos, threes = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        for token in self.ranks:
            raw = np.frombuffer(token, np.uint8).astype(np.int32)
            if len(raw) == 2:
                self.twos[raw[0] << 8 | raw[1]] = True
            threes[raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]] = True
        self.threes = np.packbits(threes, bitorder="little")
        self.ready = True
        del found, merges, threes
        give_back()  # what was held to make the tables would stay with the worker

    def _segments(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which bytes begin a segment: a piece's first, and those that no token joins to the byte before.

        A token across that boundary is these two bytes, or holds them with the
        byte before or after them.
        """
        raw = raw.astype(np.int32)
        joined = np.zeros(len(raw), bool)
        joined[1:] = self.twos[raw[:-1] << 8 | raw[1:]]
        three = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        three = (self.threes[three >> 3] >> (three & 7).astype(np.uint8) & 1).astype(bool)
        joined[2:] |= three
        joined[1:-1] |= three
        joined[starts] = False
        return ~joined

    def _contract(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        if not self.ready:
            self._prepare()
        whole = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        firsts = np.concatenate([[0], ends[:-1]])
        bounds = np.append(np.flatnonzero(self._segments(whole, firsts)), len(whole))
        lengths = np.diff(bounds)
        sizes, found = np.zeros(len(lengths), np.int64), []
        for query, chosen in ((_CONTRACT, lengths <= SHORT), (_CONTRACT_LONG, lengths > SHORT)):
            segments = np.flatnonzero(chosen)
            ends = np.cumsum(lengths[segments])
            low = 0
            while low < len(segments):
                before = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
                some = segments[low:high]
                ids, sizes[some] = self._contract_segments(query, whole, bounds[some], lengths[some])
                found.append((some, ids))
                low = high
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.zeros(starts[-1], np.int32)
        for some, ids in found:
            own = sizes[some]
            flat[np.repeat(starts[some] - np.cumsum(own) + own, own) + np.arange(len(ids))] = ids
        at = starts[np.searchsorted(bounds, np.append(firsts, len(whole)))] * 4
        raw = flat.tobytes()
        return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def _contract_segments(self, query: str, whole: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the segments in order, and how many each has."""
        needed = int(lengths.max()) * SEGMENT_BYTES >> 20
        self.db.execute(f"set memory_limit = '{max(QUERY_MB, needed)}MB'")
        total = int(lengths.sum())
        at = np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(total)
        seed = {"seg": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), "pos": (np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32), "token": self.byte_ids[whole[at]]}
        self.db.register("seed", pa.table(seed))
        done = self.db.sql(query).to_arrow_table().sort_by("seg")
        self.db.unregister("seed")
        ids = done.column("ids").combine_chunks()
        return ids.flatten().to_numpy().astype(np.int32), np.diff(ids.offsets.to_numpy())

    def _keep(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += len(piece) + len(ids) + _ENTRY_BYTES

    def learn(self, pieces: list[str]) -> None:
        """Find the ids of pieces that are not known yet."""
        chunk, raws, size = [], [], 0

        def contract() -> None:
            nonlocal size
            for piece, ids in zip(chunk, self._contract(raws), strict=True):
                self._keep(piece, ids)
            size = 0
            chunk.clear()
            raws.clear()

        for piece in pieces:
            raw = piece.encode()
            if (rank := self.ranks.get(raw)) is not None:
                self._keep(piece, rank.to_bytes(4, "little"))
                continue
            chunk.append(piece)
            raws.append(raw)
            size += len(raw)
            if size >= CHUNK_BYTES:
                contract()
        if chunk:
            contract()

    def _look_up(self, pieces: list[list[str]]) -> list[np.ndarray]:
        if self.held > self.kept:
            self.older, self.known, self.held = self.known, {}, 0
        known, older, new = self.known, self.older, []
        for piece in set().union(*pieces):
            if piece not in known:
                if piece in older:
                    self._keep(piece, older[piece])
                else:
                    new.append(piece)
        self.learn(new)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, some)), np.int32) for some in pieces]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if sum(map(len, texts)) <= BLOCK_CHARS:
            return self._look_up([self.split.findall(t) for t in texts])
        # the same, piece after piece, so that a long text's pieces are never all held
        return [np.concatenate([*(self._look_up([list(some)])[0] for some in batched((m[0] for m in self.split.finditer(t)), CHUNK_PIECES)), np.zeros(0, np.int32)]) for t in texts]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids: tokens joined by id, aggregated by position."""
        ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
        flat = ids.flatten()
        raw, sizes = [], [np.zeros(1, np.int64)]
        for low in range(0, len(flat), CHUNK_IDS):
            some = flat.slice(low, CHUNK_IDS)
            self.db.register("given", pa.table({"pos": np.arange(len(some), dtype=np.int32), "id": some}))
            tokens = self.db.sql(_JOIN).to_arrow_table().column("tokens").combine_chunks().flatten()
            self.db.unregister("given")
            bounds = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset :][: len(tokens) + 1]
            sizes.append(np.diff(bounds))
            if tokens.buffers()[2] is not None:
                raw.append(tokens.buffers()[2].slice(int(bounds[0]), int(bounds[-1] - bounds[0])))
        # the tokens' bytes lie next to each other, so a text is what lies between two of its ends
        bounds = np.cumsum(np.concatenate(sizes))[ends].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(raw))])


_codecs: dict[tuple[bytes, str, int], Codec] = {}
_drop: list[threading.Timer] = []


def _forget() -> None:
    """Free the codec of an idle worker, which may live on for other stages."""
    _codecs.clear()
    give_back()


@contextlib.contextmanager
def _codec(vocabulary: bytes, pattern: str, kept: int = KEPT_BYTES) -> Iterator[Codec]:
    """The worker's codec; it is kept from task to task and dropped after ``IDLE_SECONDS`` without one."""
    while _drop:
        _drop.pop().cancel()
    key = (vocabulary, pattern, kept)
    codec = _codecs.get(key)  # a timer that has begun may still empty the store, not this name
    if codec is None:
        _forget()
        codec = _codecs[key] = Codec(vocabulary, pattern, kept)
    try:
        yield codec
    finally:
        _drop.append(threading.Timer(IDLE_SECONDS, _forget))
        _drop[-1].daemon = True
        _drop[-1].start()


def _blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters, one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _encoded(batches: Iterator[pa.RecordBatch], codec: Codec, block: int = BLOCK_CHARS) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """The identifiers and ids of blocks of texts."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for start, end in _blocks(texts, block):
            ids = codec.encode(texts[start:end])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            yield batch.column("id").slice(start, end - start), pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.zeros(0, np.int32)]))
        pa.default_memory_pool().release_unused()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bound_batches(docs.sparkSession, rows=500, size="8m")
    return docs.selectExpr(f"cast(`{id_col}` as long) as id", f"cast(`{text_col}` as string) as text")


def encode(docs: DataFrame, vocabulary: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT_BYTES) -> DataFrame:
    """(id_col, ids array<int>): the token ids of each whole text, without special tokens.

    ``vocabulary`` is the content of a rank file (about 1 MB, sent with the tasks);
    ``kept`` bytes of pieces, and as many older ones, stay in a worker's memory.
    A null or empty text gives an empty list; rows are independent of each other,
    so repeated rows and identifiers, and null identifiers, stay as they are.  An
    empty table gives an empty result; other columns are not read.  A long text is
    taken piece after piece; only a segment (bytes each of which some token joins
    to the next, such as a run of one letter) is contracted at once, and one of
    n bytes takes about ``SEGMENT_BYTES`` times n bytes of a worker's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(vocabulary, pattern, kept) as codec:
            for id_, ids in _encoded(batches, codec):
                yield pa.record_batch({"id": id_, "ids": ids})

    return _texts(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded binary): the bytes that the ids stand for.

    An empty or null list gives no bytes; a null id or one outside the vocabulary adds none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(vocabulary, pattern) as codec:
            for batch in batches:
                for start in range(0, batch.num_rows, 100):
                    part = batch.slice(start, 100)
                    yield pa.record_batch({"id": part.column("id"), "decoded": codec.decode(part.column("ids"))})

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "id long, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT_BYTES, block: int = BLOCK_CHARS) -> DataFrame:
    """(id_col, ids, decoded): :func:`encode` and then :func:`decode` of the ids, in one pass; ``block`` characters of texts are held as pieces at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(vocabulary, pattern, kept) as codec:
            for id_, ids in _encoded(batches, codec, block):
                yield pa.record_batch({"id": id_, "ids": ids, "decoded": codec.decode(ids)})

    return _texts(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>, decoded binary").withColumnRenamed("id", id_col)
