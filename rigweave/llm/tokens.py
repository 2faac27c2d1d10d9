"""Token counts by a public tokenizer's vocabulary file."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies on every machine, and the split pattern published with it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that cuts a text into the pieces the vocabulary's merges work on.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest stretch handed to the encoder at once; a text is cut only before white space that follows a non-space.
STRETCH = 200_000


def _cuts_well(text: str, at: int) -> bool:
    """Whether a piece of PATTERN surely begins at this place: one blank or line break between two non-spaces."""
    return text[at] in " \n" and not text[at - 1].isspace() and at + 1 < len(text) and not text[at + 1].isspace()


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The whole text in stretches of about `size`, whose token counts add up exactly to the whole text's.

    Where no such place comes before the size is reached, the stretch goes on to the next one.
    """
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut > start and not _cuts_well(text, cut):
            cut -= 1
        if cut == start:
            cut = start + size
            while cut < len(text) and not _cuts_well(text, cut):
                cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def encoder(vocabulary: str = VOCABULARY):
    """A function text -> number of tokens."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(vocabulary, "rb") if line.strip())}
    encoding = tiktoken.Encoding("rigweave", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: sum(len(encoding.encode_ordinary(part)) for part in stretches(text))


def count_tokens(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """`keep` columns and n_tokens (long) of each whole text; a null or empty text has 0 tokens."""
    fields = [df.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = None
        for batch in batches:
            if count is None:
                count = encoder(vocabulary)
            out = batch[keep].copy()
            out["n_tokens"] = [0 if not isinstance(t, str) or not t else count(t) for t in batch["_text"]]
            yield out

    return df.select(*keep, F.col(text).alias("_text")).mapInPandas(run, schema)
