"""Byte-level BPE by forced boundaries: encode whole texts to token ids, and decode ids to text.

Two neighbouring bytes that stand together inside no token of the vocabulary can never be joined, whatever the
merges; a cut between them is certain. So are the cuts of the tokenizer's own pattern and of its added tokens. The
fragments between certain cuts are encoded independently of each other, and the ids of a text are those of its
fragments one after the other. A chunk of texts is cut as one vector, its distinct fragments are encoded together,
one merge rank per fragment and round, and every occurrence copies the ids of its fragment. A fragment that has no
certain cut for long is merged alone, with a heap.

The vocabulary is a ``tokenizers`` JSON file of a byte-level BPE; other kinds are refused. The path must be there on
all executors. Ids are kept as binary, little-endian unsigned 32-bit integers.

Defined cases: null and empty texts have no ids (empty binary), null or empty ids decode to the empty string. The
string of an added token in a text is that token. Ids decode to their bytes one after the other; what is no UTF-8
becomes U+FFFD. Rows are encoded one by one, so null ids, ties and repeated rows pass through, and an empty table
stays empty. A column of the input that has the name of the new column is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.llm.words import chunks

CHUNK_BYTES = 2 << 20
# Fragments over this many bytes are merged one by one.
LONG = 64
_NONE = np.int64(1) << 40  # a rank above all
_OTHER, _LETTER, _DIGIT, _SPACE, _UNKNOWN = range(5)
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes as they are, others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _joined_bytes(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Vocabulary:
    """Tokens, merges and certain cuts of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, before = stated["model"], stated.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and stated.get("normalizer") is None
            and not any(model.get(k) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in stated["added_tokens"])
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        ids = model["vocab"]
        tokens = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in stated["added_tokens"]}
        tokens |= {i: content.encode() for content, i in self.added.items()}
        self.size = max(tokens) + 1
        listed = [tokens.get(i, b"") for i in range(self.size)]
        self.token_bytes = np.frombuffer(b"".join(listed), dtype=np.uint8)
        self.token_length = np.array([len(t) for t in listed], dtype=np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.byte_id = np.array([ids[letter] for letter in byte_letters()], dtype=np.int64)

        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[p[side]] for p in pairs], dtype=np.int64) for side in (0, 1))
        merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        # Rounds that merge all places of the lowest rank at once need every part to be made before it is used.
        made = np.full(self.size, -1, dtype=np.int64)
        made[merged] = np.arange(len(pairs))
        rank = np.arange(len(pairs))
        if len(np.unique(merged)) < len(merged) or (made[left] >= rank).any() or (made[right] >= rank).any():
            raise ValueError(f"{path} has merges out of order")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.pair_rank = dict(zip(zip(left.tolist(), right.tolist()), range(len(pairs))))

        inside = np.zeros((256, 256), dtype=bool)
        for token in (tokens[i] for i in ids.values()):
            spelled = np.frombuffer(token, dtype=np.uint8)
            inside[spelled[:-1], spelled[1:]] = True
        self.certain = ~inside  # [a, b]: between bytes a and b there is always a cut
        self.kinds = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
        self._pieces = None
        self._path = path
        self._split = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added else None
        )

    def kind_of(self, points: np.ndarray) -> np.ndarray:
        """Letter, digit, space or other, as the tokenizer's own pattern sees each code point."""
        unknown = points[self.kinds[points] == _UNKNOWN]
        if len(unknown):
            if self._pieces is None:
                from tokenizers import Tokenizer

                self._pieces = Tokenizer.from_file(self._path).pre_tokenizer.pre_tokenize_str
            for point in np.unique(unknown).tolist():
                c = chr(point)
                # A code point is of a kind if nothing parts it from two others of that kind.
                same = [k for k, x in ((_LETTER, "a"), (_DIGIT, "1"), (_OTHER, "!")) if len(self._pieces(x + c + x)) == 1]
                self.kinds[point] = same[0] if same else _SPACE
        return self.kinds[points]

    def pieces(self, text: str) -> Iterable[tuple[str, int | None]]:
        """The text cut at added tokens, each piece with the id of the added token that it is."""
        if self._split is None:
            return [(text, None)]
        return [(p, self.added.get(p) if i % 2 else None) for i, p in enumerate(self._split.split(text)) if p]


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path)


def word_starts(points: np.ndarray, opens: np.ndarray, voc: Vocabulary) -> np.ndarray:
    """Where the pattern 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|\\s+(?!\\S)|\\s+ begins a match.

    ``points`` are the code points of pieces in a row and ``opens`` marks the first of each piece.
    """
    kind = voc.kind_of(points)
    n = len(points)
    space = kind == _SPACE
    blank = points == 0x20
    follows = np.zeros(n, dtype=bool)  # there is a code point before, in the same piece
    follows[1:] = ~opens[1:]
    changed = np.zeros(n, dtype=bool)
    changed[1:] = kind[1:] != kind[:-1]
    before_blank = np.zeros(n, dtype=bool)
    before_blank[1:] = blank[:-1]
    # What is no space begins a match where the kind changes, unless a blank before it begins it.
    start = ~follows | (changed & (space | ~before_blank))
    # The last space before something else stands apart from the spaces before it.
    last = np.zeros(n, dtype=bool)
    last[:-1] = space[:-1] & ~space[1:] & follows[1:]
    start |= last
    for at in np.flatnonzero(start[:-1] & (points[:-1] == 0x27)).tolist():
        after = bytes(p if p < 0x80 and f else 0 for p, f in zip(points[at + 1 : at + 3].tolist(), follows[at + 1 : at + 3]))
        if after[:1] in _ENDINGS:
            size = 2
        elif after in _ENDINGS and follows[at + 2]:
            size = 3
        else:
            continue
        start[at + 1 : at + size] = False
        if at + size < n:
            start[at + size] |= not blank[at + size - 1]
    return start


def _merged_alone(symbols: list[int], voc: Vocabulary) -> list[int]:
    """The symbols of one fragment after all merges: the lowest rank first, and of equal ones the leftmost."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = voc.pair_rank
    heap = [(r, i) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= n or rank.get((symbols[i], symbols[j])) != r:
            continue
        symbols[i], symbols[j] = int(voc.merged[r]), -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (found := rank.get((symbols[a], symbols[b]))) is not None:
                heapq.heappush(heap, (found, a))
    return [s for s in symbols if s >= 0]


def merge_all(symbols: np.ndarray, lengths: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Fragments (their symbols in a row, and how many each has) after all merges.

    Every round merges, in each fragment, all places of its lowest rank.
    """
    done_ids, done_of = [], []
    name = np.arange(len(lengths))
    while len(lengths):
        of = np.repeat(np.arange(len(lengths)), lengths)
        key = symbols[:-1] * voc.size + symbols[1:]
        at = np.searchsorted(voc.keys, key)
        at[at == len(voc.keys)] = 0
        rank = np.full(len(symbols), _NONE)
        known = (voc.keys[at] == key) & (of[:-1] == of[1:])
        rank[:-1][known] = voc.ranks[at[known]]
        lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        open_ = lowest < _NONE
        finished = ~open_[of]
        done_ids.append(symbols[finished])
        done_of.append(name[of[finished]])
        if not open_.any():
            break
        going = open_[of]
        symbols, rank, of = symbols[going], rank[going], of[going]
        join = rank == lowest[of]
        # Of places that overlap, as in a run of one symbol, every second one is merged.
        run_start = join & ~np.concatenate([[False], join[:-1]])
        offset = np.arange(len(join)) - np.maximum.accumulate(np.where(run_start, np.arange(len(join)), 0))
        join &= offset % 2 == 0
        symbols = np.where(join, voc.merged[np.where(join, rank, 0)], symbols)
        stays = ~np.concatenate([[False], join[:-1]])
        symbols, of = symbols[stays], of[stays]
        left = np.flatnonzero(open_)
        name = name[left]
        lengths = np.bincount(of, minlength=len(open_))[left]
    ids, of = np.concatenate(done_ids), np.concatenate(done_of)
    order = np.argsort(of, kind="stable")
    return ids[order], of[order]


def _distinct(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): a fragment of each kind, and for every fragment the number of its kind."""
    which = np.zeros(len(starts), dtype=np.int64)
    short = lengths <= 16
    firsts = []
    at = np.flatnonzero(short)
    if len(at):
        places = starts[at, None] + np.arange(16)
        inside = np.arange(16) < lengths[at, None]
        packed = np.where(inside, data[np.minimum(places, len(data) - 1)], 0).astype(np.uint8)
        halves = packed.view(np.uint64)
        with np.errstate(over="ignore"):
            code = (halves[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (halves[:, 0] >> np.uint64(29))
            code = (code + halves[:, 1]) * np.uint64(0xC2B2AE3D27D4EB4F) + lengths[at].astype(np.uint64)
        _, first, which_short = np.unique(code, return_index=True, return_inverse=True)
        same = (halves[first[which_short]] == halves).all(axis=1) & (lengths[at][first[which_short]] == lengths[at])
        if not same.all():  # two fragments have one code
            exact = np.concatenate([halves, lengths[at, None].astype(np.uint64)], axis=1)
            _, first, which_short = np.unique(exact, axis=0, return_index=True, return_inverse=True)
        which[at] = which_short.reshape(-1)
        firsts.append(at[first])
    seen: dict[bytes, int] = {}
    n_short, longs = sum(map(len, firsts)), []
    raw = data.tobytes() if not short.all() else b""
    for i in np.flatnonzero(~short).tolist():
        number = seen.setdefault(raw[starts[i] : starts[i] + lengths[i]], len(seen))
        if number == len(longs):
            longs.append(i)
        which[i] = n_short + number
    return np.concatenate([*firsts, np.array(longs, dtype=np.int64)]), which


def encode_texts(texts: list[str | None], voc: Vocabulary) -> list[np.ndarray]:
    """The ids of each text."""
    out = [np.zeros(0, dtype="<u4") for _ in texts]
    pieces = [(i, p, added) for i, text in enumerate(texts) if text for p, added in voc.pieces(text)]
    if not pieces:
        return out
    raw = [p.encode() for _, p, _ in pieces]
    sizes = np.array([len(b) for b in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    piece_start = np.cumsum(sizes) - sizes
    # Code points, and the byte at which each begins.
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer("".join(p for _, p, _ in pieces).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    opens = np.zeros(len(data), dtype=bool)
    opens[piece_start] = True
    cut = np.zeros(len(data), dtype=bool)
    cut[lead[word_starts(points, opens[lead], voc)]] = True
    cut[1:] |= voc.certain[data[:-1], data[1:]]
    for (_, _, added), start, size in zip(pieces, piece_start.tolist(), sizes.tolist()):
        if added is not None:
            cut[start + 1 : start + size] = False
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.append(starts, len(data)))

    first, which = _distinct(data, starts, lengths)
    size = lengths[first]
    small = np.flatnonzero(size <= LONG)
    symbols = voc.byte_id[data[_joined_bytes(starts[first[small]], size[small])]]
    ids, of = merge_all(symbols, size[small], voc)
    of = small[of]
    alone = [(int(k), _merged_alone(voc.byte_id[data[starts[first[k]] : starts[first[k]] + size[k]]].tolist(), voc))
             for k in np.flatnonzero(size > LONG)]
    if alone:
        ids = np.concatenate([ids, *(np.array(x, dtype=np.int64) for _, x in alone)])
        of = np.concatenate([of, *(np.full(len(x), k) for k, x in alone)])
        order = np.argsort(of, kind="stable")
        ids, of = ids[order], of[order]
    count = np.bincount(of, minlength=len(first))
    begin = np.cumsum(count) - count
    n_ids = count[which]
    all_ids = ids[_joined_bytes(begin[which], n_ids)].astype("<u4")
    # The ids of a text are those of its fragments in a row; an added token is one id whatever its bytes.
    fragment_piece = np.searchsorted(piece_start, starts, side="right") - 1
    per_piece = np.bincount(fragment_piece, weights=n_ids, minlength=len(pieces)).astype(np.int64)
    ends = np.cumsum(per_piece)
    found: dict[int, list[np.ndarray]] = {}
    for (i, _, added), start, end in zip(pieces, (ends - per_piece).tolist(), ends.tolist()):
        part = all_ids[start:end] if added is None else np.array([added], dtype="<u4")
        found.setdefault(i, []).append(part)
    for i, parts in found.items():
        out[i] = np.concatenate(parts)
    return out


def decode_ids(ids: np.ndarray, voc: Vocabulary) -> str:
    """The text of the ids."""
    ids = ids[ids < voc.size].astype(np.int64)
    places = _joined_bytes(voc.token_start[ids], voc.token_length[ids])
    return voc.token_bytes[places].tobytes().decode("utf-8", "replace")


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def _encoded(batches: Iterator[pa.RecordBatch], path: str, text: str, name: str, at_a_time: int):
    voc = vocabulary(path)
    for batch in chunks(batches, text, at_a_time):
        ids = encode_texts(batch.column(text).to_pylist(), voc)
        yield _with(batch, name, pa.array([i.tobytes() for i in ids], pa.binary()))


def _decoded(batches: Iterator[pa.RecordBatch], path: str, ids: str, name: str, at_a_time: int):
    voc = vocabulary(path)
    for batch in chunks(batches, ids, at_a_time):
        texts = [decode_ids(np.frombuffer(i or b"", dtype="<u4"), voc) for i in batch.column(ids).to_pylist()]
        yield _with(batch, name, pa.array(texts, pa.string()))


def _extended(df: DataFrame, run, name: str, kind: T.DataType) -> DataFrame:
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def encode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", at_a_time: int = CHUNK_BYTES
) -> DataFrame:
    """``docs`` with the binary ``ids`` of ``text`` under the vocabulary at ``path``."""
    run = partial(_encoded, path=path, text=text, name=ids, at_a_time=at_a_time)
    return _extended(docs.drop(ids), run, ids, T.BinaryType())


def decode(
    tokens: DataFrame, path: str, ids: str = "ids", text: str = "text", at_a_time: int = CHUNK_BYTES
) -> DataFrame:
    """``tokens`` with the ``text`` that binary ``ids`` spell; ids that the vocabulary lacks spell nothing."""
    run = partial(_decoded, path=path, ids=ids, name=text, at_a_time=at_a_time)
    return _extended(tokens.drop(text), run, text, T.StringType())


def n_ids(ids: str = "ids"):
    """How many ids a binary column holds."""
    return (F.length(ids) / 4).cast("long")
