"""Byte-level BPE: a backtracking encoder and an offset-table decoder."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconflow.llm.words import small_batches

#: Distinct pieces whose tokens a worker remembers, in two generations; the older goes when the younger is full.
MEMORY = 500_000
#: Pairs of tokens that a worker remembers; a full memory is emptied.
PAIRS = 250_000
#: Pieces that are looked up together, and the longest that is remembered (in characters).
SLAB, LONG = 50_000, 256
#: Below this code point, Unicode versions agree on letters, digits and blanks.
AGREED = 0x500


class Vocabulary:
    """What a tokenizer file says, in the form that is sent to the tasks.

    Supports byte-level BPE without normaliser, dropout or prefix blank, with
    one merge for each longer token, and added tokens that match anywhere.
    Anything else is a ValueError rather than a wrong result.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens with matching rules")
        letter_byte = _letters_of_bytes()
        spell = lambda token: bytes(letter_byte[c] for c in token)
        vocab: dict[str, int] = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merged = [a + b for a, b in pairs]
        made = set(merged)
        single = [t for t in vocab if t not in made]
        if len(made) != len(merged) or any(len(t) > 1 for t in single) or len(single) != 256:
            raise ValueError(f"{path} has tokens that no single merge makes")
        # Internal numbers follow the order of the merges: single bytes first.
        number = {t: i for i, t in enumerate([*single, *merged])}
        self.spelling = [spell(t) for t in number]
        self.parts = [(number[a], number[b]) for a, b in pairs]
        self.ids = np.array([vocab[t] for t in number], np.int32)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._encoder: Encoder | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encoder": None}

    def encoder(self) -> Encoder:
        """Built once in each worker, which keeps it as long as the broadcast value."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def offsets(self) -> tuple[np.ndarray, np.ndarray]:
        """All spellings in one array, and where that of each id begins (and the next one's)."""
        known = {**dict(zip(self.ids.tolist(), self.spelling, strict=True)), **{i: t.encode() for t, i in self.added.items()}}
        each = [known.get(i, b"") for i in range(max(known) + 1)]
        return np.frombuffer(b"".join(each), np.uint8), np.cumsum([0, *map(len, each)])


def _letters_of_bytes() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_pattern() -> re.Pattern:
    """The pre-tokenizer's pattern with its classes spelt out below AGREED."""
    kinds: dict[str, list[int]] = {"L": [], "N": [], "s": []}
    for c in range(AGREED):
        kind = unicodedata.category(chr(c))[0]
        blank = c in (0x20, 0x85, 0xA0) or 9 <= c <= 13
        if blank or kind in kinds:
            kinds["s" if blank else kind].append(c)
    letter, digit, blank = ("".join(re.escape(chr(c)) for c in kinds[k]) for k in "LNs")
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{blank}{letter}{digit}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


class Encoder(dict):
    """piece -> its token ids as int32 bytes; pieces are split by the tokenizer's own pattern."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.spelling, self.added = vocabulary.spelling, vocabulary.added
        self.packed = [int(i).to_bytes(4, sys.byteorder) for i in vocabulary.ids]
        n = len(self.spelling)
        base = n - len(vocabulary.parts)
        self.length = [len(s) for s in self.spelling]
        self.added_values = {t: i.to_bytes(4, sys.byteorder) for t, i in self.added.items()}
        #: pair of tokens -> the token they merge into
        self.merge = {pair: base + i for i, pair in enumerate(vocabulary.parts)}
        self.left = [*range(base), *(a for a, _ in vocabulary.parts)]
        self.right = [*range(base), *(b for _, b in vocabulary.parts)]
        number = {s: i for i, s in enumerate(self.spelling)}
        #: the longest token that is a proper prefix of each
        self.shorter = [next((number[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in number), -1) for s in self.spelling]
        self.tokens = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        #: single bytes need no search: the automaton holds the longer tokens
        self.single = [number[bytes([b])] for b in range(256)]
        for s, i in number.items():
            if len(s) > 1:
                self.tokens.add_word(s.decode("latin-1"), i)
        self.tokens.make_automaton()
        self.pieces = _piece_pattern()
        self.beyond = re.compile(f"[^\\x00-{chr(AGREED - 1)}]")
        self.specials = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.fits: dict[tuple[int, int], bool] = {}

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging leaves this pair of tokens apart wherever they stand side by side.

        They would not, if along their common border some two parts merge into a
        token earlier than both sides are complete. The border is walked down,
        each time splitting the side that was made later, until that is a single
        byte (and so is the other, as single bytes have the smallest numbers).
        """
        known = self.fits.get((first, second))
        if known is not None:
            return known
        a, b, before, answer = first, second, sys.maxsize, True
        while True:
            whole = self.merge.get((a, b))
            if whole is not None and whole < before:
                answer = False
                break
            if a > b:
                before, inner = a, self.right[a]
                if inner == a:
                    break
                a = inner
            else:
                before, inner = b + 1, self.left[b]
                if inner == b:
                    break
                b = inner
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[(first, second)] = answer
        return answer

    def longest(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """The longest token from each place on, of pieces laid side by side, and where each piece begins (and a next one would).

        One place lies between pieces: a letter that is no byte, which no token crosses.
        """
        line = "\u0100".join([p.decode("latin-1") for p in pieces])
        out = b"\0".join(pieces)
        out, length = [self.single[b] for b in out], self.length
        if len(self.tokens):
            for last, token in self.tokens.iter(line):
                out[last + 1 - length[token]] = token  # ends rise, so the longest comes last
        begins = [0]
        for p in pieces:
            begins.append(begins[-1] + len(p) + 1)
        return out, begins

    def tokens_of(self, longest: list[int], at: int, end: int) -> list[int]:
        """Internal numbers of the tokens that merging would give for the piece between two places.

        From the left the longest token is tried; one that is not compatible
        with its predecessor, or that ends where all went wrong before, gives
        way to the next shorter, and if there is none the predecessor does.
        Each place goes wrong once at most, so time is linear in the piece.
        """
        out: list[int] = []
        length, shorter, fits = self.length, self.shorter, self.fits
        dead: set[int] = set()
        token = longest[at] if at < end else -1
        while at < end:
            after = at + length[token]
            ok = after not in dead
            if ok and out:
                ok = fits.get((out[-1], token))
                if ok is None:
                    ok = self.compatible(out[-1], token)
            if ok:
                out.append(token)
                at = after
                if at < end:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
        return out

    def values(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; pieces that are new are encoded side by side."""
        found = list(map(self.get, pieces))
        if None not in found:
            return found
        new = {p: None for p, v in zip(pieces, found, strict=True) if v is None}
        missing = []
        for piece in new:
            value = self.added_values.get(piece) or self.older.get(piece)
            if value is None:
                missing.append(piece)
            else:
                new[piece] = value
        longest, begins = self.longest([p.encode() for p in missing])
        packed = self.packed
        for k, piece in enumerate(missing):
            new[piece] = b"".join([packed[t] for t in self.tokens_of(longest, begins[k], begins[k + 1] - 1)])
        out = [new[p] if v is None else v for p, v in zip(pieces, found, strict=True)]
        if len(self) + len(new) > MEMORY // 2:
            self.older = dict(self)
            self.clear()
        self.update(new if max(map(len, new)) <= LONG else {p: v for p, v in new.items() if len(p) <= LONG})
        return out

    def split(self, text: str) -> list[str]:
        if not self.beyond.search(text):
            return self.pieces.findall(text)
        from tokenizers import pre_tokenizers

        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in level.pre_tokenize_str(text)]

    def pieces_of(self, text: str) -> list[str]:
        """The pieces of a text; added tokens are pieces of their own."""
        if not self.specials or not self.specials.search(text):
            return self.split(text)
        out = []
        for part in self.specials.split(text):
            out += [part] if part in self.added else self.split(part)
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The token ids of each text; SLAB pieces are looked up at a time."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            pieces = self.pieces_of(text)
            if held and size + len(pieces) > SLAB:
                yield from self._slab(held)
                held, size = [], 0
            if len(pieces) > SLAB:
                yield np.concatenate([next(self._slab([pieces[at : at + SLAB]])) for at in range(0, len(pieces), SLAB)])
                continue
            held.append(pieces)
            size += len(pieces)
        yield from self._slab(held)

    def _slab(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        found, at = self.values(list(chain.from_iterable(texts))), 0
        for pieces in texts:
            yield np.frombuffer(b"".join(found[at : at + len(pieces)]), np.int32)
            at += len(pieces)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), kind))


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """``documents`` with the token ids of ``text`` in a column ``tokens`` (array of int).

    Null or empty text: no tokens. Texts of any length are encoded whole. Rows
    are independent; an empty table gives an empty result, a column named as
    ``tokens`` is replaced, all others are kept.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    names = [c for c in documents.columns if c != tokens]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in small_batches(batches, text, 1 << 22):
            ids = list(encoder.encode([t or "" for t in batch.column(text).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(ids, pa.int32())], [*names, tokens])

    rows = documents.select(*names)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(tokens, T.ArrayType(T.IntegerType()))]))


def spelt(letters: np.ndarray, begin: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of each of several runs of ids (``counts`` long), by an offset table; unknown ids stand for nothing."""
    known = (ids >= 0) & (ids < len(begin) - 1)
    ids = np.where(known, ids, 0)
    sizes = np.where(known, begin[ids + 1] - begin[ids], 0)
    # every byte's place: its token's offset in the table, plus how far into the token it is
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[ids] - ends + sizes, sizes)
    line = letters[place].tobytes()
    cuts = np.r_[0, ends][np.cumsum(np.r_[0, counts])].tolist()
    return [line[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def decode(documents: DataFrame, vocabulary: Vocabulary, tokens: str = "tokens", text: str = "decoded") -> DataFrame:
    """``documents`` with the text of ``tokens`` in a column ``text``; broken UTF-8 becomes U+FFFD.

    Ids that the vocabulary lacks and nulls among the ids stand for nothing;
    null tokens give an empty text. Other columns are kept.
    """
    spelling, begins = vocabulary.offsets()
    shared = documents.sparkSession.sparkContext.broadcast((spelling, begins))
    names = [c for c in documents.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                column = batch.column(tokens)
                ids = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                counts = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
                texts = [line.decode("utf-8", "replace") for line in spelt(*shared.value, ids, counts)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, text])

    rows = documents.select(*names)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())]))


def token_digests(documents: DataFrame, vocabulary: Vocabulary, lists: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``lists``, tokens of each document, encoded and decoded again.

    One pass: ids, their decimals and the decoded bytes never leave the task
    unless the lists are asked for. ids_sha256 is of the decimal ids joined by
    commas, decoded_sha256 of the decoded text in UTF-8.

    Null or empty text: no tokens, the digests of the empty text. Very long
    texts are encoded whole. Equal and repeated rows each get their row. Empty
    table: empty result. Other columns are left out, whatever their names.
    """
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary, vocabulary.offsets()))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", tokens array<int>" if lists else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value
        encoder, decimals = own.encoder(), [b"%d" % i for i in range(len(table[1]) - 1)]
        for batch in small_batches(batches, "text", 1 << 21):
            ids = list(encoder.encode([t or "" for t in batch.column("text").to_pylist()]))
            names = [hashlib.sha256(b",".join([decimals[i] for i in x.tolist()])).hexdigest() for x in ids]
            counts, decoded = np.array([len(x) for x in ids], np.int64), []
            for line in spelt(*table, np.concatenate(ids), counts):
                try:
                    line.decode()
                except UnicodeDecodeError:
                    line = line.decode("utf-8", "replace").encode()
                decoded.append(hashlib.sha256(line).hexdigest())
            out = [batch.column("doc_id"), pa.array(counts), pa.array(names, pa.string()), pa.array(decoded, pa.string())]
            out += [_lists(ids, pa.int32())] if lists else []
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "tokens"][: len(out)])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
