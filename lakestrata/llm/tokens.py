"""Token ids and counts of a word-level BPE vocabulary, one look-up per repeated chunk of text."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mixed
from .workers import kept, tidy

# one task is one core
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_TOP = 0x300
_FACTOR = 0xD1342543DE82EF95


def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _pieces() -> tuple[re.Pattern, re.Pattern]:
    """What the short way must leave to the library, and the pre-tokens of all other texts.

    The short way takes texts of code points below U+0300 whose lower case lies there too: they are in
    NFC, and each is lowered by itself. 1C-1F hex part words for Python and not for the vocabulary.
    """
    plain = [chr(i) for i in range(_TOP) if not 0x1C <= i <= 0x1F and len(chr(i).lower()) == 1 and ord(chr(i).lower()) < _TOP]
    kind = {k: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == k) for k in "LN"}
    known = "".join(re.escape(c) for c in plain)
    token = rf"'s|'t|'re|'ve|'m|'ll|'d|[{kind['L']}]+|[{kind['N']}]|[^\t-\r \x85\xa0{kind['L']}{kind['N']}]+"
    return re.compile(f"[^{known}]"), re.compile(token)


@cache
def _blank_pieces() -> re.Pattern:
    """Pre-tokens of a byte-level vocabulary, for code points below U+0300 and white space 09-0D hex and blank."""
    kind = {k: "".join(re.escape(chr(i)) for i in range(_TOP) if unicodedata.category(chr(i))[0] == k) for k in "LN"}
    rest = rf"[^\t-\r {kind['L']}{kind['N']}]+"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{kind['L']}]+| ?[{kind['N']}]+| ?{rest}|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


class _Keys:
    """Byte strings in one buffer, with a 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray | None = None):
        self.data, self.first, self.sizes = data, offsets[:-1], np.diff(offsets)
        if hashes is None:
            # a polynomial of the bytes: differences of running sums, moved back to power 0
            powers, back = (np.cumprod(np.append(np.uint64(1), np.full(len(data), f, np.uint64))) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))
            sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * powers[:-1]))
            hashes = mixed((sums[offsets[1:]] - sums[self.first]) * back[self.first] ^ self.sizes.astype(np.uint64))
        self.hashes = hashes

    @staticmethod
    def of(words: pa.Array) -> _Keys:
        words = words.cast(pa.large_binary())
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        return _Keys(np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0])

    def bytes_of(self, which: np.ndarray) -> np.ndarray:
        """The bytes of some of the strings, one after the other."""
        return self.data[_runs(self.first[which], self.sizes[which])]

    def some(self, which: np.ndarray) -> _Keys:
        return _Keys(self.bytes_of(which), np.concatenate([[0], np.cumsum(self.sizes[which])]), self.hashes[which])


class _Store:
    """A run of numbers for each of very many strings, in flat arrays: hashes in order, one buffer of keys, one of values.

    Some 40 bytes an entry. Equal hashes are confirmed on the key's own bytes; of two strings of one hash the second is
    not found and has to be put again.
    """

    def __init__(self):
        self.hashes, self.size, self.full = np.zeros(0, np.uint64), 0, 0
        # first byte and length of a key, first place and length of its values
        self.where = np.zeros((0, 4), np.uint32)
        self.keys, self.values = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint32)

    @staticmethod
    def _room(buffer: np.ndarray, used: int, more: int) -> np.ndarray:
        if used + more <= len(buffer):
            return buffer
        return np.concatenate([buffer[:used], np.zeros(more + used // 4, buffer.dtype)])

    def put(self, keys: _Keys, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Add entries; ``values`` are theirs one after the other. Returns the first place of each."""
        self.keys = self._room(self.keys, self.size, len(keys.data))
        self.values = self._room(self.values, self.full, len(values))
        self.keys[self.size : self.size + len(keys.data)] = keys.data
        self.values[self.full : self.full + len(values)] = values
        first = self.full + np.cumsum(lengths) - lengths
        where = np.column_stack([self.size + keys.first, keys.sizes, first, lengths]).astype(np.uint32)
        self.size, self.full = self.size + len(keys.data), self.full + len(values)
        new = np.argsort(keys.hashes, kind="stable")
        # put in at their places: sorting all again would hold every entry several times
        at = np.searchsorted(self.hashes, keys.hashes[new], "right")
        self.hashes, self.where = np.insert(self.hashes, at, keys.hashes[new]), np.insert(self.where, at, where[new], axis=0)
        return first

    def find(self, keys: _Keys) -> np.ndarray:
        """The row of ``where`` of each key, -1 where it is not held."""
        out = np.full(len(keys.hashes), -1, np.int64)
        if not len(self.hashes):
            return out
        place = np.minimum(np.searchsorted(self.hashes, keys.hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[place] == keys.hashes)
        hit = hit[self.where[place[hit], 1] == keys.sizes[hit]]
        sizes, theirs = keys.sizes[hit], self.where[place[hit], 0].astype(np.int64)
        differs = np.concatenate([[0], np.cumsum(keys.bytes_of(hit) != self.keys[_runs(theirs, sizes)])])
        ends = np.cumsum(sizes)
        same = hit[differs[ends] == differs[ends - sizes]]
        out[same] = place[same]
        return out


def _runs(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...`` for ``lengths[0]`` numbers, then those of the next run."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(first - before, lengths) + np.arange(int(lengths.sum()))


class _Chunks:
    """The token ids of each chunk of text, or their number.

    The chunks of a MB of text are told apart by Arrow, so a chunk is looked up once for all its places, and only
    those never met before go to the library. Past ``limit`` entries a new store begins; the one before
    stays readable, what is met again is taken over from it, and all else goes.
    """

    def __init__(self, path: str, limit: int):
        self.library, self.limit, self.now, self.before = _library(path), limit, _Store(), _Store()
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")

    def plain(self, text: str) -> str | None:
        """The text as ``split`` takes it, or None when the library has to take it as a whole."""
        raise NotImplementedError

    def split(self, texts: pa.Array) -> pa.ListArray:
        raise NotImplementedError

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The values of new chunks one after the other, and how many each has."""
        raise NotImplementedError

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """First place and length of each distinct chunk's values in the current store."""
        if len(self.now.hashes) > self.limit or self.now.size > 40 * self.limit:
            self.now, self.before = _Store(), self.now
        keys = _Keys.of(words)
        held = self.now.find(keys)
        where = np.zeros((len(held), 2), np.int64)
        where[held >= 0] = self.now.where[held[held >= 0], 2:]
        rest = np.flatnonzero(held < 0)
        old = self.before.find(keys.some(rest))
        first, lengths = self.before.where[old[old >= 0], 2:].astype(np.int64).T
        for some, values, sizes in (
            (rest[old >= 0], self.before.values[_runs(first, lengths)], lengths),
            (rest[old < 0], *self.learn(words.take(pa.array(rest[old < 0])).to_numpy(zero_copy_only=False).tolist())),
        ):
            where[some, 0], where[some, 1] = self.now.put(keys.some(some), values, sizes), sizes
        return where[:, 0], where[:, 1]

    def _some(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [self.plain(t) for t in texts]
        lists = self.split(pa.array([t or "" for t in plain], pa.large_string()))
        told = lists.flatten().dictionary_encode()
        first, lengths = self._places(told.dictionary)
        at = told.indices.to_numpy(zero_copy_only=False)
        lengths = lengths[at]
        values = self.now.values[_runs(first[at], lengths)]
        offsets = lists.offsets.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets - offsets[0]]
        for i, text in enumerate(plain):
            yield self.whole(texts[i]) if text is None else values[ends[i] : ends[i + 1]]

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The values of all chunks of each text; a MB is worked on at a time, which takes some twenty times as much memory."""
        part, held = [], 0
        for text in texts:
            part.append(text)
            held += len(text)
            if held > 1 << 20:
                yield from self._some(part)
                part, held = [], 0
        if part:
            yield from self._some(part)


class _Model:
    """The library's merges for single pre-tokens, many in one call.

    A pre-token's bytes are written in the vocabulary's letters for bytes here, so normalising and splitting the text
    again is spared. The bytes that each id stands for tell where a pre-token ends.
    """

    def __init__(self, library):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer(library.model)
        self.library.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [i for i in range(0x100) if i not in printed]
        # FF hex never occurs in UTF-8: it parts two pre-tokens
        self.letters = {i: chr(i) for i in printed} | {b: chr(0x100 + i) for i, b in enumerate(other)} | {0xFF: " "}
        words = library.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(words.values()) + 1, np.int64)
        for word, i in words.items():
            self.sizes[i] = len(word.removesuffix("</w>"))

    def encode(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all items one after the other, and how many each has."""
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for start in range(0, len(items), 10_000):
            part = [i.encode() for i in items[start : start + 10_000]]
            joined = b"\xff".join(part).decode("latin-1").translate(self.letters)
            own = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            wanted, given = np.cumsum([0, *map(len, part)]), np.concatenate([[0], np.cumsum(self.sizes[own])])
            bounds = np.searchsorted(given, wanted)
            if not np.array_equal(given[bounds], wanted):
                raise ValueError("the vocabulary's ids do not add up to the bytes of the text")
            ids.append(own)
            lengths.append(np.diff(bounds))
        return np.concatenate(ids), np.concatenate(lengths)

    def of(self, parted: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for chunks given as pre-tokens; a pre-token they share is encoded once."""
        told = pa.array([p for parts in parted for p in parts], pa.large_string()).dictionary_encode()
        ids, lengths = self.encode(told.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = told.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths[at])])[np.cumsum([0, *map(len, parted)])]
        return ids[_runs((np.cumsum(lengths) - lengths)[at], lengths[at])], np.diff(ends)


class Ids(_Chunks):
    """Token ids for a vocabulary that lowers its text and drops white space: a chunk is a run without white space."""

    def __init__(self, path: str, limit: int):
        super().__init__(path, limit)
        self.unlike, self.token = _pieces()
        self.model = _Model(self.library)

    def plain(self, text: str) -> str | None:
        if self.unlike.search(text) or self.special.search(text):
            return None
        return text.lower().replace("\x85", " ").replace("\xa0", " ")

    def split(self, texts: pa.Array) -> pa.ListArray:
        return pc.ascii_split_whitespace(texts)

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.model.of([self.token.findall(c) for c in chunks])


class Counts(Ids):
    """The number of tokens of each chunk. ``alone``: pre-tokens known to be one token each."""

    def __init__(self, path: str, limit: int, alone: frozenset[str]):
        super().__init__(path, limit)
        self.alone = alone

    def whole(self, text: str) -> np.ndarray:
        return np.array([len(super(Counts, self).whole(text))])

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parted = [self.token.findall(c) for c in chunks]
        merge = list({p for parts in parted for p in parts if p not in self.alone})
        merged = dict(zip(merge, self.model.encode(merge)[1].tolist(), strict=True))
        counts = np.array([sum(merged.get(p, 1) for p in parts) for parts in parted], np.uint32)
        return counts, np.ones(len(chunks), np.int64)


class ByteIds(_Chunks):
    """Token ids for a byte-level vocabulary: a chunk is what follows a blank up to the next one, with that blank.

    Pre-tokens of such a vocabulary hold a blank at most as their first character, so a blank with no white space on one
    of its sides always begins one. Texts where that does not hold go to the library as a whole: white space
    on both sides of a blank, or characters that not all libraries take for the same kind of white space.
    """

    #: stands before a text's first chunk, which has no blank before it
    FIRST = "\ufdd0"
    _ODD = re.compile(
        "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff" + FIRST + "]|\\s (?:\\s|\\Z)"
    )

    def __init__(self, path: str, limit: int):
        super().__init__(path, limit)
        self.model, self.token = _Model(self.library), _blank_pieces()
        self.strange = re.compile(f"[^\0-{chr(_TOP - 1)}]")

    def plain(self, text: str) -> str | None:
        return None if self._ODD.search(text) or self.special.search(text) else self.FIRST + text

    def split(self, texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(texts, " ")

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        chunks = [c[1:] if c.startswith(self.FIRST) else " " + c for c in chunks]
        strange = np.fromiter((self.strange.search(c) is not None for c in chunks), bool, len(chunks))
        ids, lengths = self.model.of([self.token.findall(c) for c, s in zip(chunks, strange, strict=True) if not s])
        if not strange.any():
            return ids, lengths
        # letters the expression above does not know: these chunks go to the library one by one
        more = [self.whole(c) for c, s in zip(chunks, strange, strict=True) if s]
        ids, lengths = np.concatenate([ids, *more]), np.concatenate([lengths, [len(m) for m in more]]).astype(np.int64)
        order = np.argsort(np.argsort(strange, kind="stable"), kind="stable")
        return ids[_runs((np.cumsum(lengths) - lengths)[order], lengths[order])], lengths[order]


@cache
def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that are proved to be one pre-token and to encode alone as one token.

    Every string of the vocabulary is encoded by the library itself; it stays when that gives exactly one
    id. The set is bounded by the vocabulary. It is made once per process: the driver makes it and sends it on.
    """
    library = _library(path)
    unlike, token = _pieces()
    texts = sorted({library.decode([i]).strip() for i in library.get_vocab(with_added_tokens=False).values()})
    texts = [t for t in texts if t and not unlike.search(t) and t == t.lower() and token.findall(t) == [t]]
    return frozenset(t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True) if len(e.ids) == 1)


def table(kind: type[_Chunks], path: str, limit: int, *more: Callable[[], object]) -> _Chunks:
    """The worker's table, kept from task to task. ``more`` is called only when the table is made."""
    return kept((kind.__name__, path, limit), lambda: kind(path, limit, *(m() for m in more)))


def count_tokens(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    cached: int = 1_000_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row: the count the library gives for the whole text.

    The driver proves once which vocabulary strings are whole tokens (49,000 short encodings) and sends the set to all
    workers; its size is bounded by the vocabulary. A pre-token
    among them counts as one; all others are merged by the library, many in one call. The counts of some
    twice ``cached`` distinct chunks at most are kept per worker, in flat arrays. Texts that are not plain Latin, and texts that hold
    a special token's string, go to the library as they are, so its defaults hold for them.

    NULL text counts as empty: 0 bytes, 0 tokens. Rows stay as they are: repeated rows give repeated
    results, a NULL id stays NULL, other columns are not read. An empty table gives an empty result.
    """

    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            if counts is None:
                counts = table(Counts, path, cached, lambda: whole.value)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = pa.array([int(c.sum()) for c in counts.of(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), n], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return read.mapInArrow(tidy(run, keeps=True), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
