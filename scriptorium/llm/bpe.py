"""Byte-pair encoding and decoding with a public tokenizer file.

White space splits a text before any merge, so the words of a text are encoded on their own and remembered, in
two generations of bounded size: when the younger is full it becomes the older, so that frequent words stay. A word that the tokenizer doesn't split further and that is longer than LEAF symbols
is encoded as a tree: its halves on their own, in one parallel batch of leaves, then joined. At a join, a
window of tokens around it is encoded anew and doubled until its outermost tokens on both sides are those that
the halves had. Each adjacent pair of tokens then occurs in some true encoding, which makes the whole the true
encoding. A text of any length thus costs memory for its own tokens, and no text is cut short.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.llm.common import map_rows, only, small_batches

LEAF = 2048
#: Words remembered in each of two generations, and the longest of them.
CACHED_WORDS = 200_000
CACHED_LENGTH = 64
#: Characters of texts looked up together, and new words given to the library together.
GROUP = 1_000_000
JOINED = 1000
#: The library's setting of whether a batch is encoded by several threads.
THREADS = "TOKENIZERS_PARALLELISM"
SPACES = str.maketrans("\t\n\r\x0b\x0c", "     ")


NO_SPACES = "\x1c\x1d\x1e\x1f"  # that str.split() takes for spaces, but the tokenizer doesn't


def words_in(text: str | None) -> list[str]:
    """The parts of a text between white space."""
    if any(map((text or "").__contains__, NO_SPACES)):
        return [w for w in text.translate(SPACES).split(" ") if w]
    return (text or "").split()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Encodes and decodes as the tokenizer file's own library does, without adding special tokens."""

    def __init__(self, path: str, leaf: int = LEAF):
        os.environ.setdefault(THREADS, "false")
        from tokenizers import Tokenizer

        self.path, self.leaf = path, leaf
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        plain = [t for t in self.whole.get_added_tokens_decoder().values() if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.cut = plain[0].content if plain else None
        self.words: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self._inner = self._last = self._batch = None

    # Parts of a long word: those that don't reach its end have no end mark.

    def _models(self):
        if self._inner is None:
            from tokenizers.models import BPE

            with open(self.path, encoding="utf-8") as f:
                model = json.load(f)["model"]
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self.suffix = model.get("end_of_word_suffix") or ""
            self._inner = BPE(vocab=model["vocab"], merges=merges)
            self._last = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix or None)
        return self._inner, self._last

    def _part(self, symbols: str, last: bool) -> list[str]:
        return [t.value for t in self._models()[last].tokenize(symbols)]

    def _leaves(self, leaves: list[str]) -> list[list[str]]:
        """Tokens of leaves that don't reach the word's end, encoded in parallel by the library's threads."""
        from tokenizers import Tokenizer

        if self._batch is None:
            self._batch = Tokenizer(self._models()[0])
        before = os.environ.get(THREADS)
        os.environ[THREADS] = "true"
        try:
            parts = [leaves[at : at + JOINED] for at in range(0, len(leaves), JOINED)]
            return [[self.tokens[i] for i in e.ids] for part in parts for e in self._batch.encode_batch_fast(part, add_special_tokens=False)]
        finally:
            os.environ[THREADS] = before or "false"

    def _bare(self, tokens: list[str], last: bool) -> str:
        joined = "".join(tokens)
        return joined.removesuffix(self.suffix) if last and self.suffix else joined

    def join(self, left: list[str], right: list[str], last: bool) -> list[str]:
        """The encoding of a word from those of its two parts."""
        width = 4
        while True:
            a, b = left[-width:], right[:width]
            ends = last and len(b) == len(right)
            new = self._part(self._bare(a, False) + self._bare(b, ends), ends)
            free_a, free_b = len(a) == len(left), len(b) == len(right)
            if (free_a or new[0] == a[0]) and (free_b or new[-1] == b[-1]) and (len(new) > 1 or free_a or free_b):
                return left[: len(left) - len(a)] + new + right[len(b) :]
            width *= 2

    def tree(self, symbols: str, last: bool = True) -> list[str]:
        """Tokens of an unsplit word of any length."""
        self._models()
        leaves = [symbols[i : i + self.leaf] for i in range(0, len(symbols), self.leaf)]
        level = [*self._leaves(leaves[:-1]), self._part(leaves[-1], last)]
        while len(level) > 1:
            n = len(level)
            level = [
                self.join(level[i], level[i + 1], last and i + 2 >= n) if i + 1 < n else level[i] for i in range(0, n, 2)
            ]
        return level[0]

    def long_word(self, word: str) -> list[int]:
        """Ids of a word without white space, special tokens in it included."""
        ids: list[int] = []
        at = 0
        for m in [*self.marks.finditer(word), None]:
            piece = word[at : m.start() if m else len(word)]
            if piece:
                for symbols, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(piece)):
                    if symbols.strip():
                        tokens = self.tree(symbols) if len(symbols) > self.leaf else self._part(symbols, True)
                        ids += [i for i in map(self.whole.token_to_id, tokens) if i is not None]
            if m:
                ids.append(self.special[m[0]])
                at = m.end()
        return ids

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """The text's ids, as little-endian unsigned 32-bit integers, and its decoded form."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None], decoded: bool = True) -> Iterator[tuple[bytes, str]]:
        """For each text its ids and, unless not asked for, its decoded form.

        Each distinct word of a group of texts is looked up once; a group ends at GROUP characters.
        """
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(words_in(text))
            size += len(text or "")
            if size >= GROUP:
                yield from self._group(group, decoded)
                group, size = [], 0
        yield from self._group(group, decoded)

    def _group(self, group: list[list[str]], decoded: bool) -> Iterator[tuple[bytes, str]]:
        ids, forms = self._lookup(set().union(*group))
        for words in group:
            yield b"".join(map(ids.__getitem__, words)), " ".join(filter(None, map(forms.__getitem__, words))) if decoded else ""

    def _lookup(self, words: set[str]) -> tuple[dict[str, bytes], dict[str, str]]:
        """Ids and decoded forms of distinct words, from two generations of remembered words or encoded now."""
        ids, forms, new = {}, {}, []
        for w in words:
            found = self.words.get(w)
            if found is None:
                found = self.older.get(w)
                if found is None:
                    new.append(w)
                    continue
                self.words[w] = found
            ids[w], forms[w] = found
        for w, found in self._encoded(new):
            ids[w], forms[w] = found
            if len(w) <= CACHED_LENGTH:
                if len(self.words) >= CACHED_WORDS:
                    self.older, self.words = self.words, {}
                self.words[w] = found
        return ids, forms

    def _encoded(self, words: list[str]) -> Iterator[tuple[str, tuple[bytes, str]]]:
        """New words with their ids and decoded forms; those of ordinary length go to the library many at once."""
        plain = []
        for w in words:
            if len(w) > self.leaf:
                yield w, self.packed(self.long_word(w))
            elif self.cut is None or self.marks.search(w):
                yield w, self.packed(self.whole.encode(w, add_special_tokens=False).ids)
            else:
                plain.append(w)
        for at in range(0, len(plain), JOINED):
            some = plain[at : at + JOINED]
            # The special token between two words is cut out before anything else is done to them.
            got = self.whole.encode_batch_fast([self.cut.join(some)], add_special_tokens=False)[0].ids
            got.append(mark := self.special[self.cut])
            raw = struct.pack(f"<{len(got)}I", *got)
            forms = list(map(self.tokens.__getitem__, got)) if self.whole.decoder is None else None
            start = 0
            for w in some:
                end = got.index(mark, start)
                yield w, (raw[4 * start : 4 * end], " ".join(forms[start:end]) if forms else self.decode(got[start:end]))
                start = end + 1

    def packed(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def decode(self, ids) -> str:
        """As the library's decode without a decoder does: the tokens, special ones too, joined by spaces."""
        if self.whole.decoder is not None:
            return self.whole.decode(list(ids), skip_special_tokens=False)
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


_codecs: dict = {}


def codec(name: str, leaf: int = LEAF) -> Codec:
    """The process's codec of a tokenizer file, given by its public name or its path."""
    if (name, leaf) not in _codecs:
        _codecs[name, leaf] = Codec(name if "/" in name else tokenizer_path(name), leaf)
    return _codecs[name, leaf]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "word_bpe_49k.json", leaf: int = LEAF) -> DataFrame:
    """Rows (doc_id, ids binary, decoded string), one for each input row.

    ids holds little-endian unsigned 32-bit integers. A null text counts as empty and has no ids; null and
    repeated ids and repeated rows keep their rows; an empty table gives no rows; other columns are ignored.
    """

    def work(rows):
        own = codec(name, leaf)
        for row, (ids, decoded) in zip(rows, own.encode_all(r["text"] for r in rows), strict=True):
            yield {"doc_id": row["doc_id"], "ids": ids, "decoded": decoded}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(only(docs, doc_id=id_col, text=text_col), f"doc_id {kind}, ids binary, decoded string", work)


def with_ids(docs: DataFrame, text_col: str = "text", name: str = "word_bpe_49k.json", out: str = "token_ids",
             decoded: str | None = None) -> DataFrame:
    """All rows and columns of docs and the text's ids, as little-endian binary, in a column `out`.

    With `decoded`, a column of that name holds the text decoded from those ids. Columns of these names are
    replaced. A null or empty text has no ids and an empty decoded text; null and repeated ids and repeated rows
    keep their rows; an empty table gives no rows.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").alias("__text")
    kept = [f for f in docs.schema.fields if f.name not in (out, decoded)]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in kept], text)
    added = [T.StructField(out, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def run(batches):
        own = codec(name)
        for batch in batches:
            pairs = list(own.encode_all(batch.column(batch.num_columns - 1).to_pylist(), decoded=decoded is not None))
            new = [pa.array([i for i, _ in pairs], pa.binary())] + ([pa.array([d for _, d in pairs], pa.string())] if decoded else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], *[f.name for f in added]])

    return docs.mapInArrow(run, T.StructType([*kept, *added]))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's ids and decoded texts."""
    return encode(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
