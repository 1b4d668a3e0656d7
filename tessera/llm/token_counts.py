"""Token counts under a unigram model: forward scores shared in a trie of distinct pre-tokens."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Trie nodes and terminals that a worker keeps; beyond either it starts anew.
MOST_NODES = 1_000_000


def piece_scores(path: str) -> dict[str, float]:
    """Log-probability of each ordinary piece of a sentencepiece vocabulary, by Zipf's law on its order by score.

    The file's own scores are merge ranks, not probabilities; no model is trained here.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    ids.sort(key=lambda i: (-sp.get_score(i), i))
    total = math.log(sum(1 / (r + 3) for r in range(len(ids))))
    return {sp.id_to_piece(i): -math.log(r + 3) - total for r, i in enumerate(ids)}


class Trie:
    """Inserted pre-tokens; each node has the best score of its prefix and the number of pieces of the best segmentation.

    A node is made once for all pre-tokens with its prefix. Of equal scores the one of fewer pieces is best. A character
    that is no piece counts a token for each UTF-8 byte, at `byte_score` each.
    """

    def __init__(self, scores: dict[str, float], most_nodes: int = MOST_NODES):
        self.scores, self.longest, self.most = scores, max(map(len, scores), default=1), most_nodes
        self.byte_score = min(scores.values(), default=0.0) - 10
        self.clear()

    def clear(self) -> None:
        self.next: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]
        self.terminals: dict[str, int] = {}

    def tokens(self, token: str) -> int:
        """Pieces of the pre-token's best segmentation."""
        found = self.terminals.get(token)
        return self.insert(token) if found is None else found

    def insert(self, token: str) -> int:
        if len(self.best) + len(token) > self.most and self.terminals:
            self.clear()
        node, path, scores, best, count = 0, [0], self.scores, self.best, self.count
        for d, c in enumerate(token, 1):
            node, above = self.next.get((node, c), -1), node
            if node < 0:
                n = len(c.encode("utf-8", "surrogatepass"))
                top, fewest = best[above] + n * self.byte_score, count[above] + n
                for j in range(max(0, d - self.longest), d):
                    s = scores.get(token[j:d])
                    if s is not None:
                        s += best[path[j]]
                        k = count[path[j]] + 1
                        if s > top or s == top and k < fewest:
                            top, fewest = s, k
                node = len(best)
                self.next[above, c] = node
                best.append(top)
                count.append(fewest)
            path.append(node)
        self.terminals[token] = count[node]
        return count[node]

    @classmethod
    def held(cls, path: str) -> Trie:
        """The one of this Python process, which outlives a task."""
        kept = sys.modules.setdefault("_tessera_kept", types.ModuleType("_tessera_kept")).__dict__
        if ("trie", path) not in kept:
            kept["trie", path] = cls(piece_scores(path))
        return kept["trie", path]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens: one row per row of docs, whole texts, no shuffle.

    Pre-tokens are runs without ASCII white space, each with a leading space mark. Each worker's trie has a bounded
    number of nodes. Null or empty text: 0. Null ids and repeated rows stay; an empty table gives no rows; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie.held(vocabulary)
        for b in batches:
            words, tokens = [], []
            for t in b.column(1):
                text = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
                words.append(len(text))
                tokens.append(sum([trie.tokens(SPACE + w.decode("utf-8", "surrogatepass")) for w in text]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
