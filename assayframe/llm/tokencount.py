"""Token counts with a shortcut for whole tokens.

Once, on the driver, the library itself proves which strings of the vocabulary it
encodes alone as one token. Texts are cut into pre-tokens; a pre-token on that list
counts one, only the others are merged by the library.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from assayframe.llm.scratch import small_batches
from assayframe.llm.text import slices

# Fixed value: the split of byte-level BPE as the library documents it.
PRE_TOKENS = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

MEMO_SIZE = 300_000


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def prove_whole(tokenizer: Tokenizer) -> list[str]:
    """The strings of the vocabulary that are one pre-token and encode alone as their own id."""
    symbols = byte_symbols()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    candidates = []
    for token, number in tokenizer.get_vocab().items():
        if token in special or any(c not in symbols for c in token):
            continue
        try:
            text = bytes(symbols[c] for c in token).decode()
        except UnicodeDecodeError:
            continue
        if PRE_TOKENS.findall(text) == [text]:
            candidates.append((text, number))
    found = tokenizer.encode_batch([t for t, _ in candidates], add_special_tokens=False)
    return [t for (t, number), e in zip(candidates, found, strict=True) if e.ids == [number]]


def differing(tokenizer: Tokenizer, last: int = 0xFFFF) -> str:
    """A pattern of the characters that the library and PRE_TOKENS cut differently.

    The two may know different versions of Unicode. All characters up to ``last`` are
    tried between letters, digits, marks and spaces; those beyond count as differing.
    """

    def same(text: str) -> bool:
        theirs = [at for _, at in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return theirs == [m.span() for m in PRE_TOKENS.finditer(text)]

    def around(c: int) -> str:
        return f"a{chr(c)}1{chr(c)}!{chr(c)} b{chr(c)}{chr(c)} "

    odd = []
    known = [c for c in range(last + 1) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(known), 256):
        block = known[i:i + 256]
        if not same("".join(map(around, block))):
            odd += [c for c in block if not same(around(c))]
    return "[" + "".join(f"\\U{c:08x}" for c in odd) + f"\\U{last + 1:08x}-\\U0010ffff]"


class Counter(dict):
    """Pre-token to number of tokens. Fills itself through the library."""

    def __init__(self, content: str, whole: list[str], odd: str):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.odd = whole, regex.compile(odd)
        self.tokenizer = Tokenizer.from_str(content)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.stop = False

    def __missing__(self, piece: str) -> int:
        if self.odd.search(piece):
            self.stop = True
            return 0
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        self[piece] = n
        return n

    def count(self, text: str) -> int:
        if len(self) > MEMO_SIZE:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        self.stop = False
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for part in parts:
            total += sum(map(self.__getitem__, PRE_TOKENS.findall(part)))
        if self.stop:  # a character that the two may cut differently
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return total


def shortcut_holds(content: str) -> bool:
    """Whether the file is plain byte-level BPE, for which the shortcut is proven."""
    made = json.loads(content)
    pre, model = made["pre_tokenizer"] or {}, made["model"]
    return (
        made["normalizer"] is None
        and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        and model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in made["added_tokens"])
    )


def count_tokens(docs: DataFrame, tokenizer: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``docs`` if None), ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text.

    ``tokenizer``: path of a byte-level BPE file of the tokenizers library on the driver;
    its content is broadcast (its size does not depend on the documents). Special strings
    in texts count as the library counts them, one each; no begin or end tokens.

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent, so copies and
    very long texts need nothing more; nothing is shuffled. Columns of ``docs`` named
    ``n_bytes`` or ``n_tokens`` give way to the new ones.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    if not shortcut_holds(content):
        raise ValueError(f"{tokenizer} is not plain byte-level BPE")
    library = Tokenizer.from_str(content)
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps((content, prove_whole(library), differing(library))))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("n_bytes", "n_tokens")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "n_bytes bigint", "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*pickle.loads(held.value))
        for batch in batches:
            sizes, counts = [], []
            for part in slices(batch.column(batch.schema.get_field_index(text))):
                sizes.append(np.diff(part.offsets))
                counts += [counter.count(part.text(i).decode("utf-8", "replace")) for i in range(len(part.rows))]
            made = [pa.array(np.concatenate([np.zeros(0, np.int64), *sizes])), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), *made], names=[*kept, "n_bytes", "n_tokens"]
            )

    return small_batches(docs).select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
