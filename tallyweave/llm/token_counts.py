"""Token counts: one walk over a trie of the distinct pre-tokens of the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyweave.llm.pieces import Lattice, Vocabulary, best_counts
from tallyweave.llm.wordblocks import answered, assembled, coded, words_of


def token_counts(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``n_words`` and ``n_tokens`` of every whole text.

    Pre-tokens are runs without ASCII white space; each is segmented by the unigram scores of
    ``vocabulary`` with its start mark. Distinct pre-tokens of the corpus meet at their owners,
    where they form a trie; forward scores are computed once per shared prefix and the count at
    a pre-token's last node goes back to wherever it stands. A null, empty or blank text has no
    words and no tokens. Repeated rows and rows with null ids stay, each with its count; further
    columns of ``docs`` play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)       # a vocabulary, of fixed size

    def split():
        return lambda content: content.encode().split()

    def answer():
        lattice = Lattice(shared.value)
        return lambda words, _: [n.to_bytes(4, "little") for n in best_counts(words, lattice)]

    def finish(codes, sizes, lengths, data):
        sums = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4").astype(np.int64)[codes])])
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return [pa.array(sizes.astype(np.int64)), pa.array(np.diff(sums[ends]))]

    blocks = coded(docs, text, keep, split)
    columns = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return assembled(blocks, answered(words_of(blocks), answer), finish, columns)
