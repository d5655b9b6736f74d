"""SentencePiece encoding and decoding: exact merges found by backtracking.

A piece sequence is what repeated merging would give exactly when each piece
merges back to itself and each adjacent pair merges back to that pair. So the
encoder goes left to right, takes the longest match of an Aho-Corasick
automaton over the pieces, checks it against the piece before by re-merging the
two, tries shorter prefixes when they do not fit, and steps back when none is
left. Positions that turned out to lead nowhere are marked in a bitfield and
not entered again, so the work stays linear in the text. Pieces are walked as
numbers: a table has the next shorter prefix of each, and pairs that were judged
are remembered by their two numbers. The new chunks of a batch of texts take
their steps together, in arrays.

No piece contains the space mark after another character, nor a line feed, so
texts are cut at those places and each distinct chunk is encoded once per
worker and generation of a bounded cache. Runs of space marks have one and the
same score in some vocabularies, and ties go to the leftmost pair, which pairwise
checks need not see: whether they find the same parts is tried when a vocabulary
is loaded, and only where they do not are chunks that begin with a run merged
directly.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from smogline.llm.common import bounded_batches, give_back, slices

SPACE = "▁"
CHUNKS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
# Bytes of chunks and their ids that a worker remembers in each of two generations,
# the greatest length of such a chunk, and pairs of pieces that it remembers in each.
CHUNK_BYTES = 32 << 20
LONGEST_CHUNK = 256
PAIRS = 200_000
# Texts up to this length are merged by scanning, longer ones by a queue.
SCANNED = 48
# Pieces are below this, and two of them make the key of a pair.
SHIFT = 22
# Chunks up to this length are walked together, if there are so many of them.
TOGETHER = 48
LEAST_TOGETHER = 32
# Slots, as a power of two, of the table of choices that chunks walked together share; it is emptied when it is full by 0.6.
SLOTS = 20


class Generations:
    """A mapping of bounded size: when the young half is full, it becomes the old one."""

    def __init__(self, size: int):
        self.size, self.used, self.young, self.old = size, 0, {}, {}

    def get(self, key):
        return self.old.get(key)

    def put(self, key, value) -> None:
        self.put_all({key: value}, 1)

    def put_all(self, entries: dict, size: int) -> None:
        if self.used >= self.size:
            self.old, self.young, self.used = self.young, {}, 0
        self.young.update(entries)
        self.used += size


class _Choices:
    """What fits after a piece, by the longest match there: a table of numbers, looked up for many at a time."""

    def __init__(self, fitting):
        self.fitting = fitting
        self.empty()

    def empty(self) -> None:
        self.keys = np.full(1 << SLOTS, -1, np.int64)
        self.values = np.zeros(1 << SLOTS, np.int32)
        self.used = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free slot where it would be."""
        mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)
        slots = mixed.astype(np.int64)
        held = self.keys[slots]
        on = np.flatnonzero((held != keys) & (held >= 0))
        while len(on):
            slots[on] = (slots[on] + 1) & ((1 << SLOTS) - 1)
            held = self.keys[slots[on]]
            on = on[(held != keys[on]) & (held >= 0)]
        return slots

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there; of those that meet at a slot one takes it, and the rest look on."""
        while len(keys):
            slots, first = np.unique(self._slots(keys), return_index=True)
            self.keys[slots], self.values[slots] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    def of(self, left: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The longest prefix of each wanted piece that fits after the left one; -1 if none does, or none is wanted."""
        out = wanted.copy()
        asked = np.flatnonzero((left >= 0) & (wanted >= 0))
        keys = left[asked].astype(np.int64) << SHIFT | wanted[asked]
        slots = self._slots(keys)
        missing = self.keys[slots] < 0
        if missing.any():
            new = np.unique(keys[missing])
            if self.used + len(new) > 0.6 * len(self.keys):
                self.empty()
                new = np.unique(keys)
            found = [self.fitting(key >> SHIFT, key & ((1 << SHIFT) - 1)) for key in new.tolist()]
            self.used += len(new)
            self._put(new, np.array(found, np.int32))
            slots = self._slots(keys)
        out[asked] = self.values[slots]
        return out


class _Singles(dict):
    """Numbers of characters; one that is no piece gets the next number after the vocabulary."""

    def __init__(self, pieces: Pieces, known: dict[str, int]):
        super().__init__(known)
        self.pieces = pieces

    def __missing__(self, character: str) -> int:
        number = self[character] = len(self.pieces.length)
        self.pieces.length.append(1)
        self.pieces.shorter.append(-1)
        self.pieces.after.append({})
        self.pieces.text_of.append(character)
        return number


class Pieces:
    """A vocabulary of merges with byte fallback, and both directions of coding."""

    def __init__(self, model_path: str):
        self.model = model = SentencePieceProcessor(model_file=model_path)
        self.vocabulary = model.vocab_size()
        ids = range(self.vocabulary)
        if any(model.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.text_of = [model.id_to_piece(i) for i in ids]
        self.control = {i for i in ids if model.is_control(i)}
        self.byte_of = {i: int(self.text_of[i][3:5], 16) for i in ids if model.is_byte(i)}
        self.id_of_byte = {byte: i for i, byte in self.byte_of.items()}
        self.unknown = model.unk_id()
        self.id_of = {
            self.text_of[i]: i
            for i in ids
            if i not in self.control and i not in self.byte_of and i != self.unknown
        }
        self.special = frozenset(self.control | set(self.byte_of) | {self.unknown})
        self.rank = {piece: -model.get_score(i) for piece, i in self.id_of.items()}
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}|\n", piece) for piece in self.id_of)
        self.pairs, self.chunks = Generations(PAIRS), Generations(CHUNK_BYTES)
        self._number(len(self.text_of))
        self.choices = _Choices(self.fitting)
        self.tied = self._tied()
        # By character, its number; 0 is not looked up yet.
        self.number_of = np.zeros(0x110000, np.int32)
        # Ids are remembered as two or four bytes each.
        self.code, self.kind = ("H", np.uint16) if model.vocab_size() <= 1 << 16 else ("I", np.uint32)
        self.end = array(self.code, [model.eos_id()]).tobytes()
        # By id, the bytes that it decodes to, and whether it begins with a space mark.
        self.surfaces = pa.array([self._surface(i) for i in ids], pa.large_binary())
        self.marked = np.array([i not in self.special and self.text_of[i].startswith(SPACE) for i in ids])

    def _number(self, size: int) -> None:
        """The automaton over pieces that merge to themselves; by piece, its length and the next shorter prefix.

        Characters that are no pieces are numbered after the vocabulary when they are met.
        """
        self.length, self.shorter = [0] * size, [-1] * size
        # What fits after a piece, by the longest match there.
        self.after: list[dict[int, int]] = [{} for _ in range(size)]
        self.judged = 0
        self.matches = ahocorasick.Automaton()
        whole = {piece for piece in self.id_of if len(piece) == 1 or self.merged(piece) == [piece]}
        self.single = _Singles(self, {piece: self.id_of[piece] for piece in whole if len(piece) == 1})
        for number in self.single.values():
            self.length[number] = 1
        # In the order of their ids: a node's children are searched in the order of their coming.
        for piece in sorted((piece for piece in whole if len(piece) > 1), key=self.id_of.get):
            self.length[self.id_of[piece]] = len(piece)
            self.matches.add_word(piece, (len(piece) - 1, self.id_of[piece]))
            prefixes = (piece[:n] for n in range(len(piece) - 1, 1, -1))
            found = next((self.id_of[prefix] for prefix in prefixes if prefix in whole), None)
            self.shorter[self.id_of[piece]] = self.single[piece[0]] if found is None else found
        self.matches.make_automaton()

    def _tied(self) -> bool:
        """Whether runs of space marks have equal scores, and backtracking may not part them as merging does.

        It does if runs merge after all else and every length up to four times the longest piece comes out alike:
        what a word takes of a run it has taken before then.
        """
        runs = [piece for piece in self.rank if len(piece) > 1 and not piece.strip(SPACE)]
        ranks = {self.rank[piece] for piece in runs}
        if len(ranks) == len(runs):
            return False
        if min(ranks) <= max((rank for piece, rank in self.rank.items() if piece.strip(SPACE)), default=-math.inf):
            return True
        texts = (SPACE * n for n in range(2, 4 * max(map(len, runs)) + 1))
        return any([self.text_of[i] for i in self.backtracked(text)] != self.merged(text) for text in texts)

    def direct(self, chunk: str) -> bool:
        """Whether a chunk is merged directly."""
        return self.tied and chunk.startswith(SPACE * 2)

    def merged(self, text: str) -> list[str]:
        """The text's parts after merging best score first, leftmost among equals."""
        return self._scanned(text) if len(text) <= SCANNED else self._queued(text)

    def _scanned(self, text: str) -> list[str]:
        rank, never = self.rank, math.inf
        parts = list(text)
        ranks = [rank.get(left + right, never) for left, right in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < never:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank.get(parts[at] + parts[at + 1], never)
            if at:
                ranks[at - 1] = rank.get(parts[at - 1] + parts[at], never)
        return parts

    def _queued(self, text: str) -> list[str]:
        parts: list[str | None] = list(text)
        size = len(parts)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < size:
                joined = parts[left] + parts[right]
                if joined in self.rank:
                    heapq.heappush(queue, (self.rank[joined], left, right, joined))

        for left in range(size - 1):
            offer(left, left + 1)
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            if parts[left] is None or parts[right] is None or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [part for part in parts if part is not None]

    def fit(self, left: int, right: int) -> bool:
        """Whether two adjacent pieces merge back to themselves; remembered."""
        key = left << SHIFT | right
        known = self.pairs.young.get(key)
        if known is None:
            known = self.pairs.get(key)
            if known is None:
                parts = [self.text_of[left], self.text_of[right]]
                known = self.merged(parts[0] + parts[1]) == parts
            self.pairs.put(key, known)
        return known

    def fitting(self, left: int, longest: int) -> int:
        """The longest prefix of a match that fits after ``left``; -1 if there is none."""
        piece = self.after[left].get(longest)
        if piece is not None:
            return piece
        piece = longest
        while piece >= 0 and not self.fit(left, piece):
            piece = self.shorter[piece]
        if self.judged >= PAIRS:
            self.judged = 0
            for row in self.after:
                row.clear()
        self.after[left][longest] = piece
        self.judged += 1
        return piece

    def longest(self, text: str) -> list[int]:
        """The longest piece that begins at each character."""
        found = [*map(self.single.__getitem__, text)]
        if len(self.matches):
            for end, (reach, piece) in self.matches.iter(text):
                found[end - reach] = piece
        return found

    def backtracked(self, text: str) -> list[int]:
        """Numbers of the same parts as ``merged``, without merging the whole."""
        if not text:
            return []
        longest, length, shorter, after = self.longest(text), self.length, self.shorter, self.after
        size = len(text)
        failed = None
        parts: list[int] = []
        position, left, wanted = 0, -1, longest[0]
        while True:
            if wanted >= 0:
                piece = after[left].get(wanted) if left >= 0 else wanted
                if piece is None:
                    piece = self.fitting(left, wanted)
                if piece >= 0:
                    end = position + length[piece]
                    if failed and end < size and failed[end]:
                        wanted = shorter[piece]
                        continue
                    parts.append(piece)
                    if end == size:
                        return parts
                    position, left, wanted = end, piece, longest[end]
                    continue
            # Nothing fits here: the piece before must be another one.
            failed = failed or bytearray(size)
            failed[position] = 1
            wanted = parts.pop()
            position -= length[wanted]
            wanted = shorter[wanted]
            left = parts[-1] if parts else -1

    def walked(self, chunks: list[str]) -> list[bytes]:
        """Ids of short chunks, packed: the walk of ``backtracked``, a step of all of them at a time."""
        joined = "\n".join(chunks) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.number_of[codes]
        if not found.all():
            for code in np.unique(codes[found == 0]).tolist():
                self.number_of[code] = self.single[chr(code)]
            found = self.number_of[codes]
        # No piece has a line feed, so matches stay within their chunks.
        longest = found.tolist()
        for last, (reach, piece) in self.matches.iter(joined):
            longest[last - reach] = piece
        longest = np.array(longest, np.int32)
        length, shorter = np.array(self.length, np.int32), np.array(self.shorter, np.int32)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        position = np.cumsum(sizes + 1) - sizes - 1
        stop = position + sizes
        left, wanted = np.full(len(chunks), -1, np.int32), longest[position]
        parts, depth = np.zeros((len(chunks), sizes.max()), np.int32), np.zeros(len(chunks), np.int64)
        failed = np.zeros(len(codes) + 1, bool)
        active = np.arange(len(chunks))
        while len(active):
            piece = self.choices.of(left[active], wanted[active])
            fits = piece >= 0
            end = position[active] + np.where(fits, length[piece], 0)
            closed = fits & failed[end] & (end < stop[active])
            wanted[active[closed]] = shorter[piece[closed]]
            taken = fits & ~closed
            at, new, end = active[taken], piece[taken], end[taken]
            parts[at, depth[at]] = new
            depth[at] += 1
            position[at], left[at] = end, new
            on = end < stop[at]
            wanted[at[on]] = longest[end[on]]
            back = active[~fits]
            # Nothing fits here: the piece before must be another one.
            failed[position[back]] = True
            depth[back] -= 1
            last = parts[back, depth[back]]
            position[back] -= length[last]
            wanted[back] = shorter[last]
            left[back] = np.where(depth[back] > 0, parts[back, depth[back] - 1], -1)
            done = at[~on]
            active = active[~np.isin(active, done, assume_unique=True)] if len(done) else active
        strange = (parts >= self.vocabulary).any(axis=1)
        packed, width = parts.astype(self.kind).tobytes(), parts.shape[1] * np.dtype(self.kind).itemsize
        ends = depth * np.dtype(self.kind).itemsize
        out = [packed[at : at + size] for at, size in zip(range(0, len(packed), width), ends.tolist())]
        for i in np.flatnonzero(strange).tolist():
            out[i] = array(self.code, self._plain(parts[i, : depth[i]].tolist())).tobytes()
        return out

    def chunk(self, text: str) -> list[int]:
        """Ids of a chunk."""
        if self.direct(text):
            parts = self.merged(text)
            numbers = [self.single[part] if len(part) == 1 else self.id_of[part] for part in parts]
        else:
            numbers = self.backtracked(text)
        return self._plain(numbers)

    def _plain(self, numbers: list[int]) -> list[int]:
        """Ids for numbers: of a character that is no piece, those of its bytes."""
        if len(self.length) == self.vocabulary or max(numbers) < self.vocabulary:
            return numbers
        ids: list[int] = []
        for number in numbers:
            if number < self.vocabulary:
                ids.append(number)
            elif self.id_of_byte:
                ids.extend(self.id_of_byte[byte] for byte in self.text_of[number].encode("utf-8"))
            else:
                ids.append(self.unknown)
        return ids

    def _surface(self, i: int) -> bytes:
        return bytes([self.byte_of[i]]) if i in self.byte_of else self.surface([i]).encode("utf-8")

    def surface(self, ids: list[int]) -> str:
        """The pieces' text with spaces for their marks; runs of bytes as UTF-8."""
        if self.special.isdisjoint(ids):
            return "".join([self.text_of[i] for i in ids]).replace(SPACE, " ")
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.control:
                out.append(self.text_of[i].replace(SPACE, " "))
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out)

    def forget(self) -> None:
        """Give up the chunks that are remembered, and the pairs, of which ``after`` knows what fitted."""
        self.chunks, self.pairs = Generations(CHUNK_BYTES), Generations(PAIRS)
        give_back()

    def encode(self, text: str | None) -> tuple[np.ndarray, str]:
        """All ids with the end id, and what these decode to."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[tuple[np.ndarray, str]]:
        """The same for many texts, whose new chunks are worked out together."""
        normal = [self.model.normalize(text or "") for text in texts]
        cut = [CHUNKS.findall(text) if self.cuts else [text] * bool(text) for text in normal]
        known = [list(map(self.chunks.young.get, chunks)) for chunks in cut]
        new = {chunk: b"" for chunks, ids in zip(cut, known) if None in ids for chunk, found in zip(chunks, ids) if found is None}
        self._work_out(new)
        rows = []
        for chunks, ids in zip(cut, known):
            if None in ids:
                ids = [new[chunk] if found is None else found for chunk, found in zip(chunks, ids)]
            rows.append(np.frombuffer(b"".join([*ids, self.end]), self.kind))
        return list(zip(rows, self.decode_all(rows)))

    def _work_out(self, new: dict[str, bytes]) -> None:
        """Fill in the ids of chunks that are not in the young generation, and remember them."""
        short = []
        for chunk, found in zip(new, list(map(self.chunks.old.get, new))):
            if found is not None:
                new[chunk] = found
            elif len(chunk) <= TOGETHER and not self.direct(chunk) and chunk != "\n":
                short.append(chunk)
            else:
                new[chunk] = array(self.code, self.chunk(chunk)).tobytes()
        if len(short) >= LEAST_TOGETHER:
            new.update(zip(short, self.walked(short)))
        else:
            new.update((chunk, array(self.code, self.chunk(chunk)).tobytes()) for chunk in short)
        kept = {chunk: ids for chunk, ids in new.items() if len(chunk) <= LONGEST_CHUNK} if any(len(chunk) > LONGEST_CHUNK for chunk in new) else new
        # A text of up to four bytes a character, the ids, two headers and a slot of the mapping.
        self.chunks.put_all(kept, 4 * sum(map(len, kept)) + sum(map(len, kept.values())) + 200 * len(kept))

    def decode(self, ids: Iterable[int]) -> str:
        """Text of any ids; the space that encoding puts in front goes."""
        ids = list(ids)
        decoded = self.surface(ids)
        first = next((i for i in ids if i not in self.control), None)
        leads = first is not None and first not in self.byte_of and self.text_of[first].startswith(SPACE)
        return decoded[1:] if leads else decoded

    def decode_all(self, rows: list[np.ndarray]) -> list[str]:
        """What ``decode`` gives for each of many rows of ids without a control id before their end, all at a time."""
        if not rows:
            return []
        found = self.surfaces.take(pa.array(np.concatenate(rows)))
        _, places, joined = found.buffers()
        ends = np.cumsum([0, *map(len, rows)])
        places = np.frombuffer(places, np.int64)[ends].tolist()
        joined = memoryview(joined or b"")
        out = []
        for ids, begin, end in zip(rows, places, places[1:]):
            leads = len(ids) and self.marked[ids[0]]
            try:
                out.append(str(joined[begin + 1 if leads else begin : end], "utf-8"))
            except UnicodeDecodeError:
                # A run of byte pieces that is no text.
                out.append(self.decode(ids.tolist()))
        return out


def _utf8(run: bytes) -> str:
    """UTF-8, with one replacement character for each byte that begins no valid character."""
    out = []
    at = 0
    while at < len(run):
        width = next((n for n in (1, 2, 3, 4) if _valid(run[at : at + n], n)), 0)
        out.append(run[at : at + width].decode("utf-8") if width else "�")
        at += width or 1
    return "".join(out)


def _valid(part: bytes, width: int) -> bool:
    try:
        return len(part) == width and len(part.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def pieces(model_path: str) -> Pieces:
    """One vocabulary per worker process and model."""
    return Pieces(model_path)


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with ``ids`` (end id included) and ``decoded``.

    Columns of those names are replaced. A NULL or empty text has the end id
    alone and decodes to an empty text. The model file must be readable at the
    same path on every worker. Text is never shuffled: rows are coded where
    they are read, one Arrow batch at a time.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
            T.StructField("decoded", T.StringType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model_path)
        for batch in slices(batches, 256):
            coded = coder.encode_all(batch.column(text).to_pylist())
            ends = np.cumsum([0, *(len(ids) for ids, _ in coded)]).astype(np.int32)
            values = np.concatenate([ids for ids, _ in coded]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            columns = [*batch.columns, lists, pa.array([decoded for _, decoded in coded], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", "decoded"])
        # The worker goes on to other work, which may need the memory.
        coder.forget()

    return docs.mapInArrow(run, schema)
