"""SentencePiece encoding and decoding by batched numpy Viterbi.

A text becomes units: a run of word marks and the characters up to the next
one (no piece holds a mark behind another character, so no piece crosses a
unit).  Every distinct unit is encoded once; units of equal length form one
matrix and advance together, position by position.  Rolling hashes of all
substrings that end at the position probe the sorted hashes of the pieces, a
maximum over the candidates picks the best piece, and its length is stored as
backpointer.  A long unit (text without blanks) is cut where no piece reaches over
and otherwise goes in windows of positions that advance together in one matrix; a
window counts from where its state agrees with that of the window before.

The score of a step follows the model's own kind, so ids equal the library's:

* unigram models: the pieces' log-probabilities;
* BPE models: scores are merge ranks, whose sum says nothing about merge order.
  There a step from the piece before it scores 0 if byte-pair merging leaves
  the two pieces side by side, and minus infinity if it would not; exactly one
  path is left.  Whether two pieces may stand side by side is decided from the
  model's merge ranks by undoing the latest merges next to the border one after
  the other: a merge across the border must never have come first.

Characters without a piece become byte pieces (or the unknown piece).  Models
with the identity normaliser and a dummy prefix are supported; others raise.

Defined results: null and empty texts have no tokens; U+2581 reads as a space,
as in the library; repeated rows get equal results; whole texts are encoded; a
table without rows gives none; other columns of any name are kept, except one
called as a result, whose name can be chosen.
The vocabulary file is read on the driver and broadcast; it is never written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawhouse.llm.common import map_texts

MARK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LONG_UNIT = 96  # longer units are cut where no piece reaches over, then into windows
BAND = 32
WINDOW, WARM = 256, 64  # positions a window settles, and those it starts before them
CACHE_UNITS = 400_000  # distinct units a task remembers before it starts anew
_TOP = np.uint64(44)
_CELLS = 1 << 16  # units times characters in one matrix


def _hash(text: str) -> np.uint64:
    value = 0
    for c in text:
        value = (value * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(value)


def merge_pieces(chars: list[str], score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain byte-pair merging: best score first, leftmost on ties.  Returns the
    pieces and the last merge."""
    parts, last = list(chars), None
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = score.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if at < 0:
            break
        last = (parts[at], parts[at + 1])
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts, last


def load_vocabulary(path: str) -> dict:
    """Tables of a SentencePiece model file, as plain arrays ready to broadcast."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    model = SentencePieceProcessor(model_proto=proto.SerializeToString())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("only the identity normaliser with a dummy prefix is supported")
    unigram = proto.trainer_spec.model_type == pb.TrainerSpec.UNIGRAM
    if not unigram and proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
        raise ValueError("only unigram and BPE models are supported")
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_unknown(i) or model.is_control(i) or model.is_unused(i))]
    if any(MARK in pieces[i].lstrip(MARK) for i in normal):
        raise ValueError("pieces across word borders are not supported")
    score = np.array([model.get_score(i) for i in range(n)])
    ids = {pieces[i]: i for i in normal}
    rank = np.full(n, -1.0)
    left, right = np.arange(n), np.arange(n)
    usable = []
    if unigram:
        usable = normal
    else:
        table = {p: float(score[i]) for p, i in ids.items() if len(p) > 1}
        known = {p for p in ids if len(p) == 1}
        for p, i in ids.items():
            if len(p) == 1:
                usable.append(i)
                continue
            parts, last = merge_pieces(list(p), table)
            if len(parts) == 1 and all(x in ids for x in last) and all(c in known for c in p):
                usable.append(i)
                left[i], right[i] = ids[last[0]], ids[last[1]]
                rank[i] = -score[i]
        if usable:
            rank -= min(0.0, rank.min()) - 1
            rank[[i for i in usable if len(pieces[i]) == 1]] = -1.0
    hashes = np.zeros(n, np.uint64)
    hashes[usable] = [_hash(pieces[i]) for i in usable]
    lengths = np.array([len(p) for p in pieces], np.int64)
    order = np.array(sorted(usable, key=lambda i: int(hashes[i])), np.int64)
    keys = hashes[order]
    if (keys[1:] == keys[:-1]).any():
        raise ValueError("two pieces share a hash")
    raw = [p.encode() for p in pieces]
    for i in range(n):
        if model.is_byte(i):
            raw[i] = bytes([int(pieces[i][3:-1], 16)])
        elif model.is_control(i):
            raw[i] = b""
        elif model.is_unknown(i):
            raw[i] = " ⁇ ".encode()
    byte_ids = np.full(256, -1, np.int64)
    for i in range(n):
        if model.is_byte(i):
            byte_ids[raw[i][0]] = i
    alphabet = {c for i in normal for c in pieces[i]}
    return {
        "unigram": unigram, "keys": keys, "key_ids": order, "hashes": hashes, "lengths": lengths, "score": score,
        "rank": rank, "left": left, "right": right, "longest": int(lengths[usable].max()) if usable else 1,
        "unknown": model.unk_id(), "byte_ids": byte_ids, "lowest": float(score[normal].min()) if normal else 0.0,
        "raw": b"".join(raw), "raw_start": np.concatenate(([0], np.cumsum([len(r) for r in raw])))[:-1],
        "raw_len": np.array([len(r) for r in raw], np.int64),
        "breaks": "".join(c for c in "\n\t\r" if c not in alphabet),
    }


class Encoder:
    """Encodes texts with one vocabulary; remembers the units it has seen."""

    def __init__(self, vocabulary: dict) -> None:
        self.v = vocabulary
        breaks = re.escape(vocabulary["breaks"])
        self.unit = re.compile(f"{MARK}+[^{MARK}{breaks}]*|[{breaks}]+|[^{MARK}{breaks}]+" if breaks else f"{MARK}+[^{MARK}]*")
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(max(LONG_UNIT, vocabulary["longest"]) + 1):
                powers.append(powers[-1] * BASE)
        self.power = np.array(powers, np.uint64)
        self.begin = np.zeros(1 << 20, bool)  # which leading 20 bits any piece's hash has
        self.begin[(vocabulary["keys"] >> _TOP).astype(np.int64)] = True
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        out = np.full(hashes.shape, -1, np.int64)
        some = self.begin[(hashes >> _TOP).astype(np.int64)]  # most substrings are no piece
        asked = hashes[some]
        if len(asked):
            keys = self.v["keys"]
            at = np.searchsorted(keys, asked)
            at[at == len(keys)] = 0
            out[some] = np.where(keys[at] == asked, self.v["key_ids"][at], -1)
        return out

    def _side_by_side(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether byte-pair merging of both pieces' text ends in just these two."""
        rank, hashes, lengths = self.v["rank"], self.v["hashes"], self.v["lengths"]
        ok = np.ones(len(first), bool)
        live = np.flatnonzero((first >= 0) & (second >= 0))  # a byte or unknown never merges
        a, b, limit = first[live], second[live], np.full(len(live), np.inf)
        while len(live):
            joined = self._find(hashes[a] * self.power[lengths[b]] + hashes[b])
            bad = (joined >= 0) & (rank[joined] < limit)
            ok[live[bad]] = False
            go = ~bad & ((rank[a] >= 0) | (rank[b] >= 0))
            live, a, b = live[go], a[go], b[go]
            undo_a = rank[a] > rank[b]
            limit = np.where(undo_a, rank[a], rank[b] + 0.5)
            a, b = np.where(undo_a, self.v["right"][a], a), np.where(undo_a, b, self.v["left"][b])
        return ok

    def _viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a matrix of code points (units of one length), and
        how many each has."""
        return self._paths(codes, *self._advance(codes)[1:], np.full(len(codes), codes.shape[1]))

    def _advance(self, codes: np.ndarray, state: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best score, last piece and its length at every position of all rows.
        ``state`` has these for the first positions, one more than the longest piece."""
        v, (m, n) = self.v, codes.shape
        unigram, longest = v["unigram"], v["longest"]
        prefix = np.zeros((m, n + 1), np.uint64)
        for j in range(n):
            prefix[:, j + 1] = prefix[:, j] * BASE + (codes[:, j].astype(np.uint64) + np.uint64(1))
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0.0
        last = np.full((m, n + 1), -1, np.int64)  # piece that ends here; -1: a character without one
        back = np.ones((m, n + 1), np.int64)
        first = 1
        if state is not None:
            first = state[0].shape[1]
            best[:, :first], last[:, :first], back[:, :first] = state
        for j in range(first, n + 1):
            reach = min(longest, j)
            size = np.arange(1, reach + 1)
            piece = self._find(prefix[:, [j]] - prefix[:, j - size] * self.power[size][None, :])
            row, k = np.nonzero(piece >= 0)
            own = piece[row, k]
            step = np.full((m, reach), -np.inf)
            if unigram:
                step[row, k] = best[row, j - 1 - k] + v["score"][own]
                lone = piece[:, 0] < 0
                step[lone, 0] = best[lone, j - 1] + v["lowest"] - 10.0
            else:
                before = np.where(j - 1 - k > 0, last[row, j - 1 - k], -1)
                fits = self._side_by_side(before, own)
                step[row[fits], k[fits]] = best[row[fits], j - 1 - k[fits]]
                lone = piece[:, 0] < 0
                step[lone, 0] = best[lone, j - 1]
            pick = step.argmax(axis=1)
            rows = np.arange(m)
            best[:, j] = step[rows, pick]
            back[:, j] = pick + 1
            last[:, j] = piece[rows, pick]
        return best, last, back

    def _paths(self, codes: np.ndarray, last: np.ndarray, back: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follow the backpointers of all rows at once, each from its own end: ids in
        a row, and how many a unit has."""
        rows = np.arange(len(codes))
        taken = []
        while (live := at > 0).any():
            piece = np.where(live, last[rows, at], -2)
            at = np.where(live, at - back[rows, at], 0)
            # a character without a piece is noted by its place, below -2
            taken.append(np.where(piece == -1, -3 - at, piece))
        path = np.stack(taken[::-1], axis=1)
        own = path != -2
        ids, length = path[own], own.sum(axis=1)
        lone = np.flatnonzero(ids < -2)
        if len(lone):
            row = np.repeat(rows, length)[lone]
            bytes_of = [self._without_piece(int(codes[r, -3 - i])) for r, i in zip(row.tolist(), ids[lone].tolist())]
            more = np.fromiter(map(len, bytes_of), np.int64, len(lone)) - 1
            width = np.ones(len(ids), np.int64)
            width[lone] += more
            ids = np.repeat(ids, width)
            ids[ids < -2] = [b for part in bytes_of for b in part]
            np.add.at(length, row, more)
        return ids, length

    def _without_piece(self, code: int) -> list[int]:
        raw = self.v["byte_ids"][np.frombuffer(chr(code).encode(), np.uint8)]
        return raw.tolist() if (raw >= 0).all() else [self.v["unknown"]]

    def _cut(self, unit: str) -> list[str]:
        """A long unit cut at every place no piece reaches over: no path crosses
        there, so the parts are encoded on their own."""
        codes, n = np.frombuffer(unit.encode("utf-32-le"), np.uint32), len(unit)
        crossed = np.zeros(n + 1, np.int64)
        h = codes.astype(np.uint64) + np.uint64(1)
        for size in range(2, min(self.v["longest"], n) + 1):
            # Hashes of all substrings of a length from shorter ones: h(s + c) = h(s) * B + c.
            h = h[: n - size + 1] * BASE + (codes[size - 1 :].astype(np.uint64) + np.uint64(1))
            at = np.flatnonzero(self._find(h) >= 0)
            np.add.at(crossed, at + 1, 1)
            np.add.at(crossed, at + size, -1)
        free = np.flatnonzero(np.cumsum(crossed)[1:n] == 0) + 1
        ends = [0, *free.tolist(), n]
        return [unit[a:b] for a, b in zip(ends, ends[1:])]

    def _windows(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of long parts, in windows that advance together.

        A window starts ``WARM`` positions early, as if the text began there.  From
        where as many positions in a row as the longest piece has agree with the
        window before (same pieces, same score differences), both go on alike, since
        a step looks no further back.  A window that does not agree goes once more
        from the state of the window before it.
        """
        need = self.v["longest"]
        width = max(WINDOW, 2 * need)
        codes = [np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in parts]
        count = [-(-len(c) // width) for c in codes]
        done: dict[tuple[int, int], tuple] = {}  # (part, window): first position, then best, last, back

        def run(jobs: list[tuple[int, int]], early: int, known: bool) -> None:
            # Rows of one length, the last windows padded: a step never looks ahead.
            length = width + early + need
            for at in range(0, len(jobs), max(1, _CELLS // length)):
                some = jobs[at : at + max(1, _CELLS // length)]
                rows = np.zeros((len(some), length), np.uint32)
                starts = [max(0, k * width - early) for _, k in some]
                for row, (p, k), start in zip(rows, some, starts):
                    own = codes[p][start : (k + 1) * width + need]
                    row[: len(own)] = own
                state = None
                if known:
                    prior = [(done[p, k - 1], start) for (p, k), start in zip(some, starts)]
                    state = tuple(np.stack([d[x][start - d[0] : start - d[0] + early + 1] for d, start in prior]) for x in (1, 2, 3))
                found = self._advance(rows, state)
                for i, ((p, k), start) in enumerate(zip(some, starts)):
                    n = min(len(codes[p]), (k + 1) * width + need) - start + 1
                    done[p, k] = (start, *(x[i, :n] for x in found))

        run([(p, k) for p, n in enumerate(count) for k in range(n)], WARM, False)
        settled = [1] * len(parts)  # windows that are known to be right
        while True:
            for p, n in enumerate(count):
                while settled[p] < n and self._agree(done[p, settled[p] - 1], done[p, settled[p]], settled[p] * width, need):
                    settled[p] += 1
            late = [(p, settled[p]) for p, n in enumerate(count) if settled[p] < n]
            if not late:
                break
            run(late, need, True)
            for p, _ in late:
                settled[p] += 1
        out = []
        for p, n in enumerate(map(len, parts)):
            last, back = np.empty(n + 1, np.int64), np.empty(n + 1, np.int64)
            for k in range(count[p]):
                a, b = k * width + 1 if k else 0, min(n, (k + 1) * width) + 1
                start, _, own_last, own_back = done[p, k]
                last[a:b], back[a:b] = own_last[a - start : b - start], own_back[a - start : b - start]
            last, back, at, ids = last.tolist(), back.tolist(), n, []
            while at > 0:
                ids += [last[at]] if last[at] >= 0 else self._without_piece(ord(parts[p][at - 1]))[::-1]
                at -= back[at]
            out.append(np.array(ids[::-1], np.int32))
        return out

    @staticmethod
    def _agree(before: tuple, after: tuple, at: int, need: int) -> bool:
        """Whether two windows agree at ``at`` and the ``need`` positions behind it."""
        i, j = at - before[0], at - after[0]
        n = min(need + 1, len(before[1]) - i, len(after[1]) - j)
        x, y = before[1][i : i + n], after[1][j : j + n]
        same = np.isfinite(x) == np.isfinite(y)
        if not same.all() or any((p[i : i + n] != q[j : j + n]).any() for p, q in zip(before[2:], after[2:])):
            return False
        gap = (x - y)[np.isfinite(x)]
        return not len(gap) or float(gap.max() - gap.min()) < 1e-9

    def _learn(self, units: list[str]) -> None:
        """Encode units not seen before and remember their ids."""
        parts: dict[str, int] = {}  # distinct parts of the units; most units are one part
        made_of: list[list[int]] = []
        for u in units:
            made_of.append([parts.setdefault(p, len(parts)) for p in (self._cut(u) if len(u) > LONG_UNIT else (u,))])
        found: list[np.ndarray] = []
        start, length, used = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), 0
        by_size: dict[int, list[tuple[str, int]]] = {}
        for p, i in parts.items():
            # Lengths above BAND stand in one matrix by bands, padded behind their ends.
            n = len(p)
            by_size.setdefault(n if n <= BAND else -(-n // BAND) * BAND if n <= LONG_UNIT else 0, []).append((p, i))
        long = by_size.pop(0, [])
        for (_, i), ids in zip(long, self._windows([p for p, _ in long])):
            start[i], length[i] = used, len(ids)
            found.append(ids)
            used += len(ids)
        for size, members in by_size.items():
            rows = max(1, _CELLS // size)
            for at in range(0, len(members), rows):
                some = members[at : at + rows]
                text = "".join(p.ljust(size, "\0") for p, _ in some).encode("utf-32-le")
                codes = np.frombuffer(text, np.uint32).reshape(len(some), size)
                ids, count = self._paths(codes, *self._advance(codes)[1:], np.array([len(p) for p, _ in some]))
                place = np.array([i for _, i in some])
                start[place] = used + np.cumsum(count) - count
                length[place] = count
                found.append(ids.astype(np.int32))
                used += len(ids)
        flat = np.concatenate(found) if found else np.empty(0, np.int32)
        order = np.array([i for own in made_of for i in own], np.int64)
        ids, ends = _gather(flat, start[order], length[order])
        bounds = ends[np.concatenate(([0], np.cumsum([len(own) for own in made_of])))]
        self.start = np.concatenate((self.start, bounds[:-1] + len(self.flat)))
        self.length = np.concatenate((self.length, np.diff(bounds)))
        self.flat = np.concatenate((self.flat, ids))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the offsets of the texts in them."""
        if len(self.index) > CACHE_UNITS:
            self._forget()
        index, fresh, codes, counts = self.index, [], [], []
        for text in texts:
            if not text:
                counts.append(0)
                continue
            units = self.unit.findall(MARK + text.replace(" ", MARK))
            for u in units:
                if u not in index:
                    index[u] = len(index)
                    fresh.append(u)
            codes.append(np.fromiter(map(index.__getitem__, units), np.int64, len(units)))
            counts.append(len(units))
        if fresh:
            self._learn(fresh)
        at = np.concatenate(codes) if codes else np.empty(0, np.int64)
        ids, ends = _gather(self.flat, self.start[at], self.length[at])
        bounds = np.concatenate(([0], np.cumsum(counts)))
        return ids, ends[bounds]


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ragged slices of ``flat`` in a row, and their offsets."""
    ends = np.concatenate(([0], np.cumsum(length)))
    where = np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)
    return flat[where], ends


def decode_ids(vocabulary: dict, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of consecutive id runs; broken UTF-8 from byte pieces becomes U+FFFD."""
    raw, ends = _gather(
        np.frombuffer(vocabulary["raw"], np.uint8), vocabulary["raw_start"][ids], vocabulary["raw_len"][ids]
    )
    data, mark, out = raw.tobytes(), MARK.encode(), []
    for a, b in zip(ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist()):
        text = data[a:b].replace(mark, b" ").decode("utf-8", "replace")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def encode(
    df: DataFrame,
    vocabulary: dict,
    text_col: str = "text",
    keep: list[str] | None = None,
    ids_out: str = "token_ids",
    same_out: str = "round_trip",
) -> DataFrame:
    """Columns ``keep`` with the token ids of each text and whether decoding them
    gives the text back (U+2581 read as a space)."""
    taken = {ids_out.lower(), same_out.lower()}
    kept = keep if keep is not None else [c for c in df.columns if c.lower() not in taken]
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def factory():
        encoder = Encoder(shared.value)

        def run(texts):
            ids, offsets = encoder.encode(texts)
            back = decode_ids(shared.value, ids, offsets)
            same = [b == (t or "").replace(MARK, " ") for t, b in zip(texts, back)]
            return {ids_out: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())), same_out: same}

        return run

    return map_texts(df, text_col, kept, {ids_out: "array<int>", same_out: "boolean"}, factory)


def decode(df: DataFrame, vocabulary: dict, ids_col: str = "token_ids", keep: list[str] | None = None, out: str = "text") -> DataFrame:
    """Columns ``keep`` with the text of an array of token ids (null: null)."""
    kept = keep if keep is not None else [c for c in df.columns if c.lower() != out.lower()]
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    source = df.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)], F.col(f"`{ids_col}`").cast("array<int>").alias("ids")
    )
    schema = T.StructType([source.schema[i] for i in range(len(kept))] + [T.StructField("o", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(len(kept))
            texts = []
            for row in ids:
                own = None if row.values is None else np.array(row.values.drop_null(), np.int64)
                texts.append(None if own is None else decode_ids(shared.value, own, np.array([0, len(own)]))[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(kept))] + [pa.array(texts, pa.string())],
                names=[f"k{i}" for i in range(len(kept))] + ["o"],
            )

    return source.mapInArrow(run, schema).toDF(*kept, out)


__all__ = ["Encoder", "decode", "decode_ids", "encode", "load_vocabulary", "merge_pieces"]
