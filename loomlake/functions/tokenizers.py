"""Tokenizers as plug-ins: anything with `encode`, an end-of-text id and a length, run over Arrow batches or as an expression."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterator
from functools import cache
from pathlib import Path
from typing import Protocol, runtime_checkable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from loomlake.functions import text as T


@runtime_checkable
class Tokenizer(Protocol):
    """What the engine needs of a tokenizer."""

    eos_token_id: int | None
    pad_token_id: int | None

    def encode(self, text: str) -> list[int]: ...

    def __len__(self) -> int: ...


class CharacterTokenizer:
    """The small character tokenizer, which is an expression."""

    eos_token_id, pad_token_id = T.EOS, T.PAD

    def __init__(self, vocabulary: int = 256):
        if vocabulary < 32:
            raise ValueError("the vocabulary needs at least 32 ids")
        self.vocabulary = vocabulary

    def __len__(self) -> int:
        return self.vocabulary

    def column(self, text: Column) -> Column:
        return T.character_ids(text, self.vocabulary)

    def encode(self, text: str) -> list[int]:
        import re

        marks = {"<|im_start|>": T.START, "<|im_end|>": T.END}
        return [marks[c] if c in marks else 4 + ord(c) % (self.vocabulary - 4) for c in re.findall(r"(?s)<\|im_start\|>|<\|im_end\|>|.", text)]

    def save(self, folder: str) -> None:
        (Path(folder) / "toy_tokenizer.json").write_text(json.dumps({"type": "toy_chatml", "vocab_size": self.vocabulary}))


class FileTokenizer:
    """A pretrained tokenizer from a file of the tokenizers library; workers open the file once each.

    eos, pad: the texts of the special tokens that end documents and fill rows up, if there are any.
    """

    def __init__(self, path: str, eos: str | None = None, pad: str | None = None):
        self.path, self.eos, self.pad = path, eos, pad

    def _open(self):
        return _opened(self.path)

    def _id(self, token: str | None) -> int | None:
        if token is None:
            return None
        found = self._open().token_to_id(token)
        if found is None:
            raise ValueError(f"the tokenizer has no token {token!r}")
        return found

    @property
    def eos_token_id(self) -> int | None:
        return self._id(self.eos)

    @property
    def pad_token_id(self) -> int | None:
        return self._id(self.pad)

    def encode(self, text: str) -> list[int]:
        return self._open().encode(text, add_special_tokens=False).ids

    def __len__(self) -> int:
        return self._open().get_vocab_size()


@cache
def _opened(path: str):
    from tokenizers import Tokenizer as Library

    opened = Library.from_file(path)
    opened.no_padding()
    opened.no_truncation()
    return opened


def tokenized(docs: DataFrame, tokenizer: Tokenizer, end: bool = True, ids: str = "ids") -> DataFrame:
    """docs with the ids of text, and the end-of-text id behind them if the tokenizer has one."""
    last = [tokenizer.eos_token_id] if end and tokenizer.eos_token_id is not None else []
    if hasattr(tokenizer, "column"):
        found = tokenizer.column(F.coalesce("text", F.lit("")))
        return docs.withColumn(ids, F.concat(found, F.array(*map(F.lit, last))) if last else found)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[*tokenizer.encode(t or ""), *last] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))]))


def check_vocabulary(tokenizer: Tokenizer, model_vocabulary: int, slack: int = 4096) -> None:
    """Raise if the model has too few ids for the tokenizer; warn if it has many more."""
    if len(tokenizer) > model_vocabulary:
        raise ValueError(f"the tokenizer has {len(tokenizer)} ids, the model only {model_vocabulary}")
    if model_vocabulary - len(tokenizer) > slack:
        warnings.warn(f"{model_vocabulary - len(tokenizer)} ids of the model are never used", stacklevel=2)


def check_ids(rows: DataFrame, model_vocabulary: int, ids: str = "ids") -> None:
    """Raise if any id is not one of the model's."""
    most = rows.agg(F.max(F.array_max(ids))).first()[0]
    if most is not None and most >= model_vocabulary:
        raise ValueError(f"id {most} is not below {model_vocabulary}")
