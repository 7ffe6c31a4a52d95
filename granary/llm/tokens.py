"""Token counts and ids: batch encoding inside Arrow functions.

The pattern of a byte-level BPE always begins a new token where white space follows a
visible character, and where a letter follows a stop or bracket, so a text may be cut there
without changing its ids; texts of Latin characters are cut into pre-tokens outright.  The pieces
of a batch that were not seen before are encoded together by the library and their results
kept in a bounded table per worker.  Batches are balanced by UTF-8 bytes.  Tokenizers of another
kind get whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of text that are encoded together.
BATCH_BYTES = 1 << 20
#: Pieces kept per worker before the table is emptied.
KEEP = 400_000

#: Letters and other visible characters whose class is the same in all Unicode tables.
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0391-\u03a1\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_STOP = r".,;:!?()\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"
#: Ends of parts that keep their ids apart from what follows.
_SAFE = re.compile(f"[!-~{_LETTER}{_STOP}](?=[ \t-\r])|[{_STOP}](?=[{_LETTER}])")
#: Fixed value: the pre-token pattern of byte-level BPE, with its classes written out for
#: characters up to U+024F, where all libraries agree on them.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^ \t-\r{_L}{_N}]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: What keeps a text from being split by it: other characters, odd white space.
_NOT_LATIN = re.compile("[^\0-\x1b\x20-\x7e\xa1-\u024f]")
#: Byte-level spelling: printable bytes as themselves, the others from code point 256 on.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_SPELLED = {b: 256 + i for i, b in enumerate(_OTHERS)}
_LOADED: dict = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file, or `name` itself when it is a path."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load(name: str = TOKENIZER):
    """The library's tokenizer of a .json or .model file, once per worker."""
    if name not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_path(name)
        if name.endswith(".model"):
            import sentencepiece

            _LOADED[name] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            _LOADED[name] = Tokenizer.from_file(path)
    return _LOADED[name]


def is_byte_level(name: str = TOKENIZER) -> bool:
    """Whether texts may be cut: a .json tokenizer that only splits by the byte-level pattern."""
    if not name.endswith(".json"):
        return False
    if ("byte level", name) not in _LOADED:
        with open(tokenizer_path(name), encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        _LOADED["byte level", name] = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not any(_SAFE.search(t["content"]) or "<" not in t["content"] for t in spec["added_tokens"])
    return _LOADED["byte level", name]


def pieces(text: str) -> list[str]:
    """`text` cut at safe boundaries; joined they are `text`."""
    ends = [m.end() for m in _SAFE.finditer(text)]
    return [text[i:j] for i, j in zip([0, *ends], [*ends, len(text)], strict=True)]


class Encoder:
    """Ids (as little-endian unsigned 32-bit bytes) or lengths of whole texts.

    Lengths come from batches that the library encodes.  For ids, pre-tokens are given to the
    library's model one by one, which returns them sooner than a batch of encodings does.
    """

    def __init__(self, name: str = TOKENIZER, lengths: bool = False):
        self.name, self.lengths, self.kept = name, lengths, {}
        self.load = load(name)
        self.cuts = is_byte_level(name)

    def cut(self, text: str) -> list[str]:
        """Parts whose ids, joined, are those of the text."""
        if not self.cuts:
            return [text]
        if "<" not in text and not _NOT_LATIN.search(text):
            return _TOKEN.findall(text)
        return pieces(text)

    def _batched(self, new: list[str]) -> list[bytes]:
        out = []
        for run in by_bytes(new):
            if self.name.endswith(".model"):
                ids = self.load.encode(run, num_threads=1)
            else:
                ids = [e.ids for e in self.load.encode_batch_fast(run, add_special_tokens=False)]
            out += [array("I", i).tobytes() for i in ids]
        return out

    def _ids(self, new: list[str]) -> list[bytes]:
        if self.lengths or not self.cuts:
            return self._batched(new)
        found, rest, tokenize = {}, [], self.load.model.tokenize
        for p in new:
            if "<" not in p and not _NOT_LATIN.search(p) and _TOKEN.fullmatch(p):
                spelled = p.replace(" ", "\u0120") if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(_SPELLED)
                found[p] = array("I", [t.id for t in tokenize(spelled)]).tobytes()
            else:
                rest.append(p)
        found.update(zip(rest, self._batched(rest), strict=True))
        return [found[p] for p in new]

    def _encode(self, new: list[str]) -> None:
        for text, ids in zip(new, self._ids(new), strict=True):
            self.kept[text] = len(ids) // 4 if self.lengths else ids

    def __call__(self, texts: list[str]) -> list:
        """One result per text; `texts` should be about BATCH_BYTES together."""
        cut = [self.cut(t) for t in texts]
        new = set().union(*cut).difference(self.kept) if cut else set()
        if new:
            if len(self.kept) + len(new) > KEEP:
                self.kept.clear()
                new = set().union(*cut)
            self._encode(list(new))
        get = self.kept.__getitem__
        return [sum(map(get, c)) for c in cut] if self.lengths else [b"".join(map(get, c)) for c in cut]


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def by_bytes(texts: list[str | None], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Consecutive runs of texts of about `limit` UTF-8 bytes; a null text is empty."""
    run, size = [], 0
    for t in texts:
        t = t or ""
        n = n_bytes(t)
        if run and size + n > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += n
    if run:
        yield run


def split_long(text: str, limit: int = BATCH_BYTES) -> list[str]:
    """A long text in parts of about `limit` characters, cut at safe boundaries only: the first
    from `limit` on.  A run without any, such as one word, stays whole."""
    out, at = [], 0
    while len(text) - at > limit and (m := _SAFE.search(text, at + limit)):
        out.append(text[at : m.end()])
        at = m.end()
    return [*out, text[at:]]


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, limit: int = 512) -> DataFrame:
    """`key`, n_bytes, n_tokens, over_limit (n_tokens > `limit`), one row per input row.

    A null text counts as empty: 0 bytes, 0 tokens.  Repeated rows and null keys give a row
    each.  Other columns are not carried.  Only a narrow map: no shuffle at all.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, lengths=True)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            whole = [split_long(t) if t else [""] for t in texts] if encode.cuts else [[t or ""] for t in texts]
            flat = [p for parts in whole for p in parts]
            n = np.fromiter((x for run in by_bytes(flat) for x in encode(run)), dtype=np.int64, count=len(flat))
            ends = np.cumsum([len(parts) for parts in whole], dtype=np.int64)
            total = np.concatenate([[0], np.cumsum(n)])
            tokens = total[ends] - total[ends - [len(parts) for parts in whole]] if len(whole) else n
            size = pc.fill_null(pc.cast(pc.binary_length(batch.column(1)), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(tokens, pa.int64()), pa.array(tokens > limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
