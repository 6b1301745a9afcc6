"""Token counts by a count-only Viterbi over a unigram vocabulary.

The tokenizer: each space begins a new piece of text, with a mark in the space's place, and a text that begins
with neither gets a mark before it; a piece
is segmented into vocabulary entries so that their scores add up to the most; a character that no entry covers alone
costs ``UNKNOWN_PENALTY`` below the least score, and what is unknown falls back to one token a byte. An Aho-Corasick
automaton enumerates the vocabulary's matches in a piece; dynamic programming goes over the ends of matches from left to
right and carries, for each place, the best score and the number of tokens on that path, not the path. Ties: of equal
scores, the one reached first stays, that is the one whose last entry begins earliest.

Texts are counted where they are read; nothing is shuffled. A worker keeps the counts of up to ``CACHE`` pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.common import table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 1 << 18
#: Pieces longer than this are counted anew each time, so that the cache stays small.
CACHED_CHARS = 64
#: Places of a long piece that are dropped at a time.
KEPT = 1 << 14


@cache
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """The plain entries of a vocabulary file and their scores; control, unknown and byte entries are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(k), model.get_score(k)) for k in range(model.vocab_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k)))


class Counter:
    """Counts tokens. ``entries``: (entry, score), distinct and not empty."""

    def __init__(self, entries: tuple[tuple[str, float], ...]):
        self.automaton = ahocorasick.Automaton()
        for entry, score in entries:
            self.automaton.add_word(entry, (len(entry), score))
        if entries:
            self.automaton.make_automaton()
        self.entries = bool(entries)
        self.unknown = min((s for _, s in entries), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(e) for e, _ in entries), default=0)
        self.known: dict[str, int] = {}

    def piece(self, text: str) -> int:
        """Tokens of a piece: the best score to each place, and the tokens on the way there. Only the places that an entry still can begin at are kept."""
        n = len(text)
        score: list[float | None] = [0.0, None]  # of places from base on, up to the next one
        count = [0, 0]
        base = done = 0  # places up to done have their best
        single = False

        def close() -> None:
            """Close place done + 1: unknown, if no entry of one character ends there."""
            nonlocal base, done, single
            k = done - base
            if not single:
                s = score[k] + self.unknown
                if score[k + 1] is None or s > score[k + 1]:
                    score[k + 1], count[k + 1] = s, count[k] + len(text[done].encode("utf-8", "surrogatepass"))
            score.append(None)
            count.append(0)
            done, single = done + 1, False
            if k > KEPT + self.longest:
                del score[:KEPT], count[:KEPT]
                base += KEPT

        for end, (length, gain) in self.automaton.iter(text) if self.entries else ():
            while done < end:
                close()
            # matches with one end come longest first, so the earliest beginning is tried first
            k = end + 1 - base
            s = score[k - length] + gain
            if score[k] is None or s > score[k]:
                score[k], count[k] = s, count[k - length] + 1
            single = single or length == 1
        while done < n:
            close()
        return count[n - base]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        marked = text.replace(" ", MARK)
        for part in marked.removeprefix(MARK).split(MARK):
            got = self.known.get(part)
            if got is None:
                got = self.piece(MARK + part)
                if len(part) <= CACHED_CHARS:
                    if len(self.known) >= CACHE:
                        self.known.clear()
                    self.known[part] = got
            total += got
        return total


#: Of this worker, by what the vocabulary holds.
_counters: dict[int, Counter] = {}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """(id long, n_chars long, n_tokens long): a row for each row of ``docs``.

    Null text: as an empty one, without tokens. Equal rows count alike; no rows give no rows. Only the two named columns
    are read. ``path``: the vocabulary file, on the driver; executors get its entries, which do not grow with the data.
    """
    read = vocabulary(path)
    entries, name = docs.sparkSession.sparkContext.broadcast(read), zlib.crc32(repr(read).encode())  # a vocabulary, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _counters:
            _counters[name] = Counter(entries.value)
        counter = _counters[name]
        for batch in batches:
            texts = batch.column(1)
            n = [counter(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.as_py() or "") for t in texts], pa.int64()), pa.array(n, pa.int64())], names=["id", "n_chars", "n_tokens"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "id long, n_chars long, n_tokens long")


def op2_tokens(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, whole texts."""
    return token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
