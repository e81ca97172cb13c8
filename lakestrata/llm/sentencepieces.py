"""SentencePiece encoding that keeps the place of every piece, and decoding."""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from lakestrata.llm.common import shipped, whole

shipped(__name__)

# Fixed by the model format: the sign for a space, and the kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Words whose pieces a worker remembers, and the longest word it remembers.
_CACHED_WORDS = 600_000
_CACHED_LENGTH = 48
_NEVER = float("-inf")
#: Tokens in a batch that goes back to Spark.
_BATCH_TOKENS = 1 << 19


class CharacterMap:
    """The compiled character map: a double-array trie over UTF-8 bytes, and the texts it maps to."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes and replacement of the longest entry that ``data`` has at ``at``."""
        units, found = self.units, None
        node = self._offset(units[0])
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            unit = units[node]
            # A label holds the byte; its top bit marks the unit of a value.
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        end = self.texts.index(b"\0", found[1])
        return found[0], self.texts[found[1] : end]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Codec:
    """A BPE model: ``encode`` gives ids with byte places, ``decode`` the text of ids."""

    def __init__(self, model: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError("the model is not a BPE model")
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        # The compiled map may be empty: then every character stays as it is.
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.space = SPACE if spec.escape_whitespaces else " "
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = proto.trainer_spec.unk_surface
        self.fallback = proto.trainer_spec.byte_fallback
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER, UNUSED)}
        self.scores = {p: proto.pieces[i].score for p, i in self.ids.items()}
        self.unused = {p for p, i in self.ids.items() if self.kinds[i] == UNUSED}
        self.user = sorted((p for p, i in self.ids.items() if self.kinds[i] == USER), key=len, reverse=True)
        self.identity = not (self.map or self.squeeze or self.user or self.suffix)
        kinds = list(zip(self.pieces, self.kinds, strict=True))
        self.widths = np.array([1 if k == BYTE else len(p.encode()) for p, k in kinds])
        self.words = self._word_pattern()
        self.known = _Words(self)
        self.texts = np.array([self._text(i) for i in range(len(kinds))], dtype=object)
        # A byte below 128 is a character by itself, others are read together.
        self.parts = np.array([self.byte_of.get(i, 0) >= 0x80 for i in range(len(kinds))])

    def _text(self, i: int) -> str:
        kind = self.kinds[i]
        if kind == BYTE:
            return chr(self.byte_of[i])
        return "" if kind == CONTROL else self.unknown_text if kind == UNKNOWN else self.pieces[i].replace(SPACE, " ")

    def _word_pattern(self) -> re.Pattern[str]:
        """Cuts that no merge can cross, so words are encoded one by one and remembered.

        A cut before a space sign is safe if no piece has one after another
        character, a line break stands alone if no piece holds it. Else a text
        is one word.
        """
        inner = any(self.space in p.lstrip(self.space) for p in self.ids)
        broken = any("\n" in p and len(p) > 1 for p in self.ids)
        if inner or broken or self.user:
            return re.compile(r"[\s\S]+")
        s = self.space
        return re.compile(rf"{s}*[^{s}\n]+|{s}+|\n")

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the byte of ``text`` it comes from.

        At each place the longest user-defined symbol is taken as it is, else
        the longest entry of the character map is replaced, else one character
        is kept. What is kept points byte by byte, what is replaced to its start.
        """
        data = text.encode()
        at, chunks = 0, []
        while at < len(data):
            took, out = self._prefix(data, at)
            chunks.append((out, at, took))
            at += took
        if self.squeeze:
            while chunks and chunks[0][0].strip(b" ") == b"":
                chunks.pop(0)
        if not chunks:
            return "", np.zeros(1, np.int64)
        sign = self.space.encode()
        made, places = [], []

        def put(part: bytes, place: int) -> None:
            made.append(part)
            kept = data.startswith(part, place)
            places.extend(range(place, place + len(part)) if kept else [place] * len(part))

        if self.dummy and not self.suffix:
            # The sign put first stands for no byte, also before a sign of the text itself.
            made.append(sign)
            places.extend([chunks[0][1]] * len(sign))
        blank = self.squeeze
        for out, place, _ in chunks:
            if self.squeeze and blank:
                out = out.lstrip(b" ")
            if not out:
                continue
            if self.squeeze:
                out = re.sub(rb" +$", b" ", out) if out.endswith(b" ") else out
                blank = out.endswith(b" ")
            put(out.replace(b" ", sign), place)
        end = chunks[-1][1] + chunks[-1][2]
        whole_text = b"".join(made)
        while self.squeeze and whole_text.endswith(sign):
            whole_text = whole_text[: -len(sign)]
            end = places[len(whole_text)]
            del places[len(whole_text) :]
        if self.dummy and self.suffix:
            whole_text += sign
            places.extend([end] * len(sign))
        return whole_text.decode(errors="replace"), np.array([*places, end], np.int64)

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.user:
            raw = symbol.encode()
            if data.startswith(raw, at):
                return len(raw), raw
        if self.map and (hit := self.map.longest(data, at)):
            return hit
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, data[at : at + size]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and the byte places in ``text`` at which pieces begin; the last entry is the end.

        Piece i spans places i to i + 1 of the text. Pieces for single bytes of
        a character the model lacks each span their own byte.
        """
        made, places = self._identity(text) if self.identity else self.normalise(text)
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, self.words.findall(made))), np.int32)
        if not self.fallback and (ids == self.unknown).any():
            return self._with_unknown(made, ids, places)
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.widths[ids], out=ends[1:])
        return ids, places[ends]

    def _identity(self, text: str) -> tuple[str, np.ndarray]:
        """``normalise`` for a map without entries: each longest prefix is one character, and only spaces change."""
        data = np.frombuffer(text.encode(), np.uint8)
        if not len(data):
            return "", np.zeros(1, np.int64)
        sign = len(self.space.encode())
        first = sign if self.dummy else 0
        places = np.zeros(first + len(data) + (sign - 1) * np.count_nonzero(data == 0x20) + 1, np.int64)
        places[first:-1] = np.repeat(np.arange(len(data)), np.where(data == 0x20, sign, 1))
        places[-1] = len(data)
        return (self.space if self.dummy else "") + text.replace(" ", self.space), places

    def _with_unknown(self, made: str, ids: np.ndarray, places: np.ndarray):
        """Places when the model has no byte pieces: an unknown piece spans one character."""
        ends, at = [0], 0
        for i in ids.tolist():
            at += len(self.pieces[i]) if i != self.unknown else 1
            ends.append(at)
        sizes = np.r_[0, np.cumsum([len(c.encode()) for c in made])]
        return ids, places[sizes[ends]]

    def merge(self, word: str) -> list[int]:
        """BPE: the best-scored pair of neighbours is merged again and again, the first of equals."""
        parts = self._symbols(word)
        parts = self._merge_short(parts) if len(parts) <= _CACHED_LENGTH else self._merge_long(parts)
        if not self.unused:
            try:
                return [self.ids[part] for part in parts]
            except KeyError:
                pass
        out: list[int] = []
        for part in parts:
            out.extend(self._piece_ids(part))
        return out

    def _symbols(self, word: str) -> list[str]:
        if not self.user:
            return list(word)
        pattern = "|".join(map(re.escape, self.user))
        return re.findall(rf"{pattern}|[\s\S]", word)

    def _merge_short(self, parts: list[str]) -> list[str]:
        score, none = self.scores.get, _NEVER
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            i = pairs.index(best)
            both = parts[i] + parts.pop(i + 1)
            parts[i] = both
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + both, none)
            if i < len(pairs):
                pairs[i] = score(both + parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap and links, for words without cuts."""
        score = self.scores.get
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts) and (s := score(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, j, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            # An offer lapses when either side has changed since.
            if not parts[i] or not parts[j] or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p]

    def _piece_ids(self, part: str) -> list[int]:
        if part in self.unused:
            # A piece the model may not use goes back to the best pair it came from.
            cuts = [(min(self.scores.get(part[:k], 0), self.scores.get(part[k:], 0)), -k) for k in range(1, len(part))
                    if part[:k] in self.scores and part[k:] in self.scores]
            if cuts:
                k = -max(cuts)[1]
                return self._piece_ids(part[:k]) + self._piece_ids(part[k:])
        if part in self.ids:
            return [self.ids[part]]
        if self.fallback:
            return [self.byte_ids[b] for b in part.encode()]
        return [self.unknown]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; the sign that encoding put first is taken off again."""
        if not len(ids):
            return ""
        out = self.texts[ids].tolist()
        if (self.dummy or self.squeeze) and self.pieces[ids[0]].startswith(SPACE):
            out[0] = out[0][1:]
        part = self.parts[ids]
        if part.any():
            # Neighbouring bytes are read as UTF-8 together.
            edges = np.flatnonzero(np.diff(np.r_[False, part, False])).tolist()
            for start, end in zip(edges[::2], edges[1::2], strict=True):
                raw = bytes(self.byte_of[i] for i in ids[start:end].tolist())
                out[start:end] = [raw.decode(errors="replace"), *[""] * (end - start - 1)]
        return "".join(out)


class _Words(dict):
    """The ids of each word, as the bytes of 32-bit numbers; short words are remembered."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.codec.merge(word)).tobytes()
        if len(word) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


def encoded(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids, places, decoded.

    ``ids`` are those of the ``model`` (the bytes of its file) without begin and
    end ids; ``places`` has one more entry than ``ids``, and piece i spans the
    bytes places[i] to places[i + 1] of the text; ``decoded`` is the text that
    the ids give back. Null and empty texts have no ids, one place (0) and an
    empty text. Repeated rows each keep their row, an empty table gives no rows,
    and other columns are not looked at.

    Documents stay where they are; a worker remembers the pieces of a bounded
    number of words.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, places array<int>, decoded string"
    return rows.mapInArrow(_encoder(shared), schema)


def _encoder(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)

        def lists(parts: list[np.ndarray]) -> pa.Array:
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

        for batch in batches:
            start, held = 0, 0
            ids, places, texts = [], [], []
            for n, text in enumerate(batch.column(1)):
                one, at = codec.encode(text.as_py())
                ids.append(one)
                places.append(at)
                texts.append(codec.decode(one))
                held += len(one)
                if held >= _BATCH_TOKENS or n + 1 == batch.num_rows:
                    columns = [batch.column(0).slice(start, len(ids)), lists(ids), lists(places), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "places", "decoded"])
                    start, held = n + 1, 0
                    ids, places, texts = [], [], []

    return encode
