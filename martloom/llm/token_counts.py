"""Unigram token counts through a trie of pre-tokens.

A pre-token is a word with the word mark before it. Each distinct pre-token of a task is inserted in a
trie once; the forward score of a prefix (the best sum of piece scores that ends there, and its number
of pieces) is computed when its node is made and shared by all pre-tokens that begin with it. The node
where a pre-token ends holds its count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SHARED = 64  # characters of a pre-token that the trie keeps; what follows is computed, not stored
SCHEMA = "doc_id long, n_pretokens long, n_tokens long"


def rank_scores(model_file: str) -> dict[str, float]:
    """Scores for the pieces of a public vocabulary: log-probabilities that fall with the rank (Zipf).

    Control, unknown and byte pieces are left out; a character in no piece falls back to its bytes.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    norm = math.log(sum(1 / (rank + 1) for rank in range(len(ids))))
    return {model.id_to_piece(i): -math.log(rank + 1) - norm for rank, i in enumerate(ids)}


class PretokenTrie:
    """Forward scores by prefix. ``max_nodes`` bounds the memory: a full trie starts over, which costs
    work and changes no count."""

    def __init__(self, scores: Mapping[str, float], max_nodes: int = 1_000_000) -> None:
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte_score = min(scores.values(), default=0.0) - 10.0
        self.max_nodes = max_nodes
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[float] = [0.0]
        self.pieces: list[int] = [0]
        self.terminal: dict[bytes, int] = {}

    def _forward(self, token: str, end: int, best: list[float], pieces: list[int]) -> tuple[float, int]:
        """Best score and piece count of ``token[:end]`` from those of its prefixes; of equal scores, fewer."""
        n_bytes = len(token[end - 1].encode("utf-8", "surrogatepass"))
        top, count = best[end - 1] + n_bytes * self.byte_score, pieces[end - 1] + n_bytes
        scores = self.scores
        for start in range(max(0, end - self.longest), end):
            score = scores.get(token[start:end])
            if score is not None:
                score += best[start]
                if score > top or (score == top and pieces[start] + 1 < count):
                    top, count = score, pieces[start] + 1
        return top, count

    def count(self, word: bytes) -> int:
        """Tokens of a word given as UTF-8."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        if len(self.best) + len(self.terminal) > self.max_nodes:
            self.clear()
        token = WORD_MARK + word.decode()
        best, pieces = [0.0], [0]
        node = 0
        for end in range(1, len(token) + 1):
            if end > SHARED:
                score, n = self._forward(token, end, best, pieces)
            else:
                edge = (node, token[end - 1])
                found = self.child.get(edge)
                if found is None:
                    score, n = self._forward(token, end, best, pieces)
                    found = self.child[edge] = len(self.best)
                    self.best.append(score)
                    self.pieces.append(n)
                node = found
                score, n = self.best[node], self.pieces[node]
            best.append(score)
            pieces.append(n)
        if len(token) <= SHARED:
            self.terminal[word] = pieces[-1]
        return pieces[-1]


def token_counts(df: DataFrame, vocabulary: str = VOCABULARY, scores: Mapping[str, float] | None = None) -> DataFrame:
    """Per row: its pre-tokens and the tokens of their best segmentation.

    The vocabulary (a fixed file, about 32,000 pieces) is read on the driver and sent to the tasks; each
    task builds its own trie as it reads, so neither texts nor words are shuffled. Null and empty texts
    count 0. Repeated rows are counted one by one. Other columns of the input are not read.
    """
    spark = df.sparkSession
    pieces = spark.sparkContext.broadcast(dict(scores) if scores is not None else rank_scores(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PretokenTrie(pieces.value)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column("text").to_pylist():
                split = (text or "").encode().split()
                n, total = len(split), sum(map(trie.count, split))
                words.append(n)
                tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_pretokens", "n_tokens"],
            )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, SCHEMA)
