"""Byte-pair encoding with merges that need no replay, and decoding by an offset table.

The encoder never applies merges one by one. A piece of text is covered greedily
with the longest tokens, as an Aho-Corasick automaton finds them; a token may
follow another only if byte-pair merging of the two strings side by side leaves
exactly these two tokens. Where that fails the encoder takes the next shorter
token, or gives up the token before it; a position that was given up is never
tried again, so the work is linear. A sequence in which every neighbouring pair
is compatible is the one that the merges produce.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from unicodedata import category

import ahocorasick
import numpy as np
import pyarrow as pa

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from telltale.llm.tasks import chunks, others, ship
from telltale.llm.word_digests import column_bytes, cut_digests

# The pattern that cuts text before merging, as the vocabulary was made with.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Units, pieces and pairs that an encoder remembers during a task.
CACHE_ENTRIES = 400_000
PAIR_ENTRIES = 300_000
# Units whose ids from the library a worker remembers, about 200 bytes each.
LIBRARY_ENTRIES = 1_600_000
# Units that the library encodes as one text.
LOT = 2000

# White space other than lone spaces and lone line ends: strings that tell it apart.
_LOOSE = ("  ", " \n", "\n ", "\n\n", *"\t\v\f\r\x1c\x1d\x1e\x1f")
_LOOSE_WIDE = tuple(c for c in map(chr, range(0x80, 0x3001)) if c.isspace())
_MARKS = ",.;:!?#$%&*|"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letters under which byte-level vocabularies store bytes.

    Printable Latin-1 characters stand for themselves, all other bytes follow
    from code point 256 on in their order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """Cuts text into the pieces inside which tokens lie.

    The pattern runs in ``regex``, which knows characters newer than the
    ``tokenizers`` library does; text with a character that Python's own tables
    do not know is cut by the library.
    """

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        self._find = regex.compile(PIECES).findall
        self._cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or all(category(c) != "Cn" for c in text):
            return self._find(text)
        return [text[a:b] for _, (a, b) in self._cut(text)]


class Vocabulary:
    """Tokens, the merge that makes each of them, and the added tokens of a tokenizer file."""

    def __init__(self, spec: str):
        whole = json.loads(spec)
        model = whole["model"]
        letters = byte_letters()
        # A name with letters outside the byte alphabet stands for its own UTF-8.
        names = {i: name for name, i in model["vocab"].items()}
        added = {t["id"]: t["content"] for t in whole.get("added_tokens") or []}
        size = max([*names, *added], default=-1) + 1
        self.tokens: list[bytes] = []
        for i in range(size):
            name = added.get(i, names.get(i, ""))
            plain = i in added or any(c not in letters for c in name)
            self.tokens.append(name.encode() if plain else bytes(letters[c] for c in name))
        self.added = {content: i for i, content in added.items()}
        self.ids = {self.tokens[i]: i for i in names if i not in added}
        self.made: dict[int, tuple[int, int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (model["vocab"][n] for n in (left, right))
            self.merge[a, b] = rank
            self.made.setdefault(model["vocab"][left + right], (rank, a, b))
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in self.tokens], out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def text(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; what is no UTF-8 becomes replacement characters."""
        return self.decode(ids).decode("utf-8", "replace")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids, gathered from the offset table."""
        starts, ends = self.offsets[ids], self.offsets[ids.astype(np.int64) + 1]
        sizes = ends - starts
        shift = starts - np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(ids) else starts
        return self.bytes[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()


class Encoder:
    """Encodes texts exactly as the merges of a vocabulary would."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._pieces = Pieces()
        self._spines: tuple[dict, dict] = ({}, {})
        self._fits: dict[tuple[int, int], bool] = {}
        self._piece_ids: dict[str, tuple[int, ...]] = {}
        self._sizes = [len(t) for t in vocabulary.tokens]
        # A token that its own merges cannot make is never produced.
        self._automaton = ahocorasick.Automaton()
        self._shorter: dict[int, int | None] = {}
        reachable = {}
        for token, i in vocabulary.ids.items():
            made = vocabulary.made.get(i)
            if token and (made is None and len(token) == 1 or made and self.compatible(*made[1:], made[0])):
                reachable[token] = i
        for token, i in reachable.items():
            prefixes = (reachable.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self._shorter[i] = next((p for p in prefixes if p is not None), None)
            self._automaton.add_word(token.decode("latin-1"), i)
        self._automaton.make_automaton()
        self.units = Units(self._unit, list(vocabulary.added))
        self.forget()

    def forget(self) -> None:
        """Give up what was remembered; a worker lives longer than a task."""
        self.units.forget()
        self._piece_ids.clear()
        self._fits.clear()
        for spine in self._spines:
            spine.clear()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.units.encode(text), "<u4").tolist()

    def _unit(self, unit: str) -> bytes:
        out: list[int] = []
        for part in self.units.around_added(unit):
            if part in self.vocabulary.added:
                out.append(self.vocabulary.added[part])
                continue
            for piece in self._pieces(part):
                found = self._piece_ids.get(piece)
                if found is None:
                    if len(self._piece_ids) >= CACHE_ENTRIES // 4:
                        self._piece_ids.clear()
                    found = self._piece_ids[piece] = self.encode_piece(piece.encode())
                out += found
        return id_bytes(out)

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Cover one piece with the longest tokens that fit, stepping back where none does."""
        whole = self.vocabulary.ids.get(piece)
        if whole in self._shorter:
            return (whole,)
        sizes, shorter, known = self._sizes, self._shorter, self._fits
        # Matches come by their end, so the last one kept for a start is the longest.
        longest: list[int | None] = [None] * (len(piece) + 1)
        for end, token in self._automaton.iter(piece.decode("latin-1")):
            longest[end - sizes[token] + 1] = token
        given_up = bytearray(len(piece) + 1)
        out: list[int] = []
        at, before, token, size = 0, None, longest[0], len(piece)
        while at < size:
            while token is not None:
                end = at + sizes[token]
                if not given_up[end]:
                    if before is None:
                        break
                    fits = known.get((before, token))
                    if self.fits(before, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at, before, token = end, token, longest[end]
            elif not out:
                raise ValueError("a byte of the text has no token in the vocabulary")
            else:
                given_up[at] = 1
                token = out.pop()
                before = out[-1] if out else None
                at -= sizes[token]
                token = shorter[token]
        return tuple(out)

    def fits(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= PAIR_ENTRIES:
                self._fits.clear()
            known = self._fits[key] = self.compatible(left, right)
        return known

    def compatible(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether merging the strings of two tokens side by side leaves the two tokens.

        Follows in time what touches the seam: the last part of the left token
        and the first part of the right one, each of which grows when its merge
        is due. A merge across the seam that is due first breaks the pair; of
        equal merges the leftmost is done first. ``limit`` is the rank of the
        merge that joins the two in the end, if that one is allowed.
        """
        a_spine, b_spine = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        never = len(self.vocabulary.merge) + 1
        while True:
            a, a_due = a_spine[i]
            b, b_due = b_spine[j]
            across = self.vocabulary.merge.get((a, b), never)
            due = min(a_due, b_due)
            if due >= never:
                return across >= (never if limit is None else limit)
            if across < a_due and across <= b_due:
                return False
            if a_due <= b_due:
                i += 1
            else:
                j += 1

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token at its right (1) or left (0) end, each with the rank of the
        merge that takes it up, from the single byte to the whole."""
        known = self._spines[side].get(token)
        if known is None:
            known = [(token, len(self.vocabulary.merge) + 1)]
            part = token
            while part in self.vocabulary.made:
                rank, *halves = self.vocabulary.made[part]
                part = halves[side]
                known.append((part, rank))
            known.reverse()
            self._spines[side][token] = known
        return known


def id_bytes(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """Ids of units as bytes, found once. A unit follows a space, or is led by a line end."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids = self[unit] = self._encode(unit if unit[:1] == "\n" else " " + unit)
        return ids


class Units:
    """Cuts a text where no token can cross and remembers the ids of every unit.

    A single space between two characters that are not white space always begins
    a piece, and a single line end is a piece of its own, so the text can be cut
    before them. White space in any other form stays inside a unit. Added tokens
    hold no spaces, so they stay inside too.
    """

    def __init__(self, encode, added: list[str]):
        self._encode, self._known = encode, _Known(encode)
        self._added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self._whole = any(re.search(r"\s", a) for a in added)

    def forget(self) -> None:
        self._known.clear()

    def around_added(self, text: str) -> list[str]:
        return [p for p in self._added.split(text) if p] if self._added else [text]

    def is_plain(self, text: str) -> bool:
        return not (
            self._whole
            or any(map(text.__contains__, _LOOSE))
            or not text.isascii()
            and any(map(text.__contains__, _LOOSE_WIDE))
        )

    def cut(self, text: str, plain: bool) -> list[str]:
        if plain:
            return text.replace("\n", " \n").split(" ")
        return [text] if self._whole else _LONE_SPACE.split(text)

    def encode(self, text: str) -> bytes:
        """The ids of a text, four little-endian bytes each."""
        return self._ids_of(self.cut(text, self.is_plain(text)))

    def _ids_of(self, units: list[str]) -> bytes:
        if len(self._known) > CACHE_ENTRIES:
            self._known.clear()
        return self._encode(units[0]) + b"".join(map(self._known.__getitem__, units[1:]))


def tokenizer_spec(path: str) -> str:
    """The text of a tokenizer file, read on the driver. Its size is that of a vocabulary."""
    with open(path, encoding="utf-8") as file:
        return file.read()


class LibraryUnits(Units):
    """The same with units encoded by the ``tokenizers`` library.

    New units are encoded as the lines of one text: a line end between two units is
    always a piece of its own.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        added = [t["content"] for t in json.loads(spec).get("added_tokens") or []]
        super().__init__(lambda unit: id_bytes(self._ids(unit)), added)
        ends = self._ids("\n")
        self._end = ends[0] if len(ends) == 1 else None
        self._by_digest: dict[int, bytes] = {}
        self._marks = _Known(lambda marks: id_bytes(self._ids(marks[1:])))

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def many(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of the texts of a column; NULL as an empty text.

        Units are told apart by digests, so each is looked up once for many texts.
        """
        texts = column.to_pylist()
        plain = np.array([self.is_plain(t or "") for t in texts], bool)
        if self._end is None:
            plain[:] = False
        found = iter(self._plain(column.filter(pa.array(plain))))
        return [
            next(found) if p else np.frombuffer(self.encode(t), "<u4")
            for t, p in zip(texts, plain.tolist())
        ]

    def _plain(self, column: pa.Array) -> list[np.ndarray]:
        data, edges = column_bytes(column)
        begins = (data == 32) | (data == 10)
        begins[edges[:-1][edges[:-1] < edges[1:]]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        keys, index, which = np.unique(
            cut_digests(data, starts, ends), return_index=True, return_inverse=True
        )
        if len(self._by_digest) > LIBRARY_ENTRIES:
            self._by_digest.clear()
        ids = list(map(self._by_digest.get, keys.tolist()))
        new = [k for k, raw in enumerate(ids) if raw is None]
        at = index[new]
        cuts = [data[a:b].tobytes().decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        for k, raw in zip(new, self._encoded(cuts)):
            ids[k] = self._by_digest[int(keys[k])] = raw
        # Every unit takes its ids from those of the distinct ones.
        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.array([len(raw) // 4 for raw in ids], np.int64)
        begin, many = (np.cumsum(sizes) - sizes)[which], sizes[which]
        shift = begin - (np.cumsum(many) - many)
        whole = flat[np.repeat(shift, many) + np.arange(int(many.sum()))]
        upto = np.append(0, np.cumsum(many))[np.searchsorted(starts, edges)]
        return [whole[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def _encoded(self, cuts: list[str]) -> list[bytes]:
        """Ids of units with the space or line end before them, if there is one."""
        units = [u[1:] if u[0] == " " else u if u[0] == "\n" else "\n" + u for u in cuts]
        self._known.clear()
        self._learn([u for u in dict.fromkeys(units) if u and u != "\n"])
        # A unit at the beginning was encoded behind a line end, which is cut off.
        return [self._known[k][0 if u[0] in " \n" else 4 :] for u, k in zip(cuts, units)]

    def _learn(self, units: list[str]) -> None:
        """Units without white space but for a line end in front.

        Marks behind a letter or number are a piece of their own, so the rest is
        encoded once whatever follows it.
        """
        marked = {}
        for u in units:
            stem = u.rstrip(_MARKS)
            if stem and len(stem) < len(u) and stem[-1].isalnum():
                marked[u] = stem
        wanted = {*marked.values(), *(u for u in units if u not in marked)}
        wanted = [u for u in wanted if u not in self._known]
        for led in (True, False):
            self._lines([u for u in wanted if (u[0] == "\n") == led], led)
        for u, stem in marked.items():
            self._known[u] = self._known[stem] + self._marks[u[len(stem) :]]

    def _lines(self, units: list[str], led: bool) -> None:
        """Encode units in lots. A unit led by a line end has it in the line before."""
        lead = id_bytes([self._end]) if led else b""
        lots = [units[i : i + LOT] for i in range(0, len(units), LOT)]
        lines = ["".join([f"{u[1:]}\n" if led else f" {u}\n" for u in lot]) for lot in lots]
        found = self._tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        for lot, encoded in zip(lots, found):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(ids == self._end)
            if len(ends) == len(lot):
                raw, stops = ids.tobytes(), (4 * ends).tolist()
                cuts = map(raw.__getitem__, map(slice, [0, *[e + 4 for e in stops]], stops))
                self._known.update(zip(lot, map(lead.__add__, cuts) if led else cuts))


_made: dict[tuple[str, int], object] = {}


def per_worker(kind, spec: str):
    """One object per worker process for a tokenizer file."""
    key = (kind.__name__, hash(spec))
    if key not in _made:
        _made[key] = kind(spec)
    return _made[key]


def _encoder(spec: str) -> Encoder:
    return Encoder(Vocabulary(spec))


def encode_texts(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    into: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """Add the ids of every text as binary, four little-endian bytes each.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers``
    library. A NULL text is encoded as an empty one, which has no ids. With
    ``decoded`` the text that the ids decode to is added too, in the same pass.
    All other columns are kept; a column of a new name is replaced.
    """
    new = {into: BinaryType()} | ({decoded: StringType()} if decoded else {})
    kept = others(docs.schema.fields, new)
    schema = StructType([*kept, *[StructField(n, t, False) for n, t in new.items()]])
    spec = ship(docs.sparkSession).sparkContext.broadcast(tokenizer_spec(tokenizer))
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(_encoder, spec.value)
        for batch in chunks(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            ids = list(map(encoder.units.encode, texts))
            columns = [*map(batch.column, names), pa.array(ids, pa.binary())]
            if decoded:
                found = [encoder.vocabulary.text(np.frombuffer(x, "<u4")) for x in ids]
                columns.append(pa.array(found, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *new])
        encoder.forget()

    return docs.select(*docs.columns).mapInArrow(run, schema)


def decode_ids(
    encoded: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """Add the text of ids, special tokens included. NULL ids give an empty text.

    Bytes that are no UTF-8 are shown as replacement characters.
    """
    kept = others(encoded.schema.fields, [into])
    schema = StructType([*kept, StructField(into, StringType(), False)])
    spec = ship(encoded.sparkSession).sparkContext.broadcast(tokenizer_spec(tokenizer))
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = per_worker(Vocabulary, spec.value)
        for batch in chunks(batches, ids):
            found = [
                vocabulary.text(np.frombuffer(b or b"", "<u4"))
                for b in batch.column(ids).to_pylist()
            ]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.string())], names=[*names, into]
            )

    return encoded.mapInArrow(run, schema)


def count_ids(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """The encoded length of every text as ``n_tokens``, without its ids."""
    schema = StructType([StructField("n_tokens", LongType(), False)])
    spec = ship(docs.sparkSession).sparkContext.broadcast(tokenizer_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = per_worker(LibraryUnits, spec.value)
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(ids) for ids in units.many(batch.column("text"))], pa.int64())],
                names=["n_tokens"],
            )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, schema)

