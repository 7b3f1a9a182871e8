"""Token counts of whole texts, huge ones in overlapping chunks that are spliced where both sides provably agree.

The byte-level pattern splits a text from left to right and looks a few characters ahead, never back. So if two runs over
the same text, begun at different places, both start a piece at position p, all their pieces from p on are the same. A
chunk's piece starts are trusted up to MARGIN characters before its end (what lies ahead of them is there, and no special
string is cut). The next chunk begins inside the overlap; the first common piece start in it that is trusted is the
splice, if no white space is in front of it (only there could the end of the left part change what is in it). If there is none, the overlap is doubled, at last to the rest of the text. Tokens never cross
pieces, so the counts of both sides add up to the whole text's.

As tokens never cross pieces, a piece's count is the same wherever it stands: pieces that were met before are not encoded
again (the memory is emptied at KNOWN pieces). They are split with the pattern below; each new character's class is asked
from the library first, and a chunk with a character that the two see differently, or with a special string, is encoded by
the library as it is.

Other kinds of tokenizers give no such proof and encode every text whole.

Defined cases: null text counts as empty (0 bytes, 0 tokens); each row is counted by itself, so ties, repeated rows and
null ids need nothing more; other columns are ignored.
"""

from __future__ import annotations

import collections
import json
import operator
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP, MARGIN, BATCH, KNOWN = 1 << 16, 1 << 9, 64, 1 << 20, 400_000
#: A fixed value: the public byte-level pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter:
    """Counts tokens with the library for the file: tokenizers for .json, sentencepiece for .model."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.chunk, self.overlap, self.pieces = chunk, overlap, None
        if path.endswith(".json"):
            import regex
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.encode = lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                kind = json.load(f)
            pre = kind.get("pre_tokenizer") or {}
            if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not kind.get("normalizer"):
                if all(not (a["single_word"] or a["lstrip"] or a["rstrip"]) and len(a["content"]) < MARGIN // 2 for a in kind["added_tokens"]):
                    self.special = [a["content"] for a in kind["added_tokens"]]
                    self.library, self.pieces = t, t.pre_tokenizer.pre_tokenize_str
                    self.by_library, self.encode = self.encode, self.by_piece
                    self.split, self.known, self.same, self.other = regex.compile(PATTERN).findall, {}, set(), set()
        else:
            import sentencepiece

            t = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in t.encode(texts, num_threads=1)]

    def agrees(self, c: str) -> bool:
        """Whether the pattern and the library put a character into the same class: with letters, digits, signs or none."""
        return all(len(self.split(x + c + x)) == len(self.pieces(x + c + x)) for x in "a1.") and self.split(c) != []

    def by_piece(self, texts: list[str]) -> list[int]:
        out, rest, mets = [0] * len(texts), [], {}
        for i, text in enumerate(texts):
            chars = set(text)
            for c in chars - self.same - self.other:
                (self.same if self.agrees(c) else self.other).add(c)
            if chars & self.other or any(s in text for s in self.special):
                rest.append(i)
            else:
                mets[i] = collections.Counter(self.split(text))
        new = {p for met in mets.values() for p in met if p not in self.known}
        if len(self.known) + len(new) > KNOWN:
            self.known, new = {}, set().union(*mets.values())
        self.learn(new)
        known = self.known
        for i, met in mets.items():
            out[i] = sum(map(operator.mul, met.values(), map(known.__getitem__, met)))
        for i, n in zip(rest, self.by_library([texts[i] for i in rest]), strict=True):
            out[i] = n
        return out

    def learn(self, pieces: set[str]) -> None:
        """Counts of new pieces. Letters with a space in front stay a piece between others of that kind, letters alone stay
        one between line ends, so these are encoded as one text; the library numbers each token's piece."""
        rest = set(pieces)
        for some, between in (([p for p in pieces if p[0] == " " and p[1:].isalpha()], ""), ([p for p in pieces if p.isalpha()], "\n")):
            for k in range(0, len(some), 50_000):
                part = some[k : k + 50_000]
                at = collections.Counter(self.library.encode(between.join(part), add_special_tokens=False).word_ids)
                step = 1 + len(between)
                if len(at) == step * (len(part) - 1) + 1:
                    self.known.update((p, at[step * i]) for i, p in enumerate(part))
                    rest.difference_update(part)
        each = list(rest)
        self.known.update(zip(each, self.by_library(each), strict=True))

    def starts(self, text: str) -> list[int]:
        """Where pieces start in a text: special strings are cut out first, then the pattern runs over what is between."""
        out, at = [], 0
        while at < len(text):
            cuts = [(i, -len(s)) for s in self.special if (i := text.find(s, at)) >= 0]
            stop, size = min(cuts, default=(len(text), 0))
            out += [at + a for _, (a, _) in self.pieces(text[at:stop])]
            if size:
                out.append(stop)
            at = stop - size
        return out

    def splits(self, text: str) -> list[int]:
        """Where a long text may be cut without changing its tokens."""
        cuts, begin = [], 0
        while len(text) - begin > self.chunk:
            end, over, cut = begin + self.chunk, self.overlap, None
            while cut is None:
                low = max(begin + 1, end - over)
                #: The left run is over the whole chunk; only where it starts pieces in the overlap matters.
                left = {begin + p for p in self.starts(text[begin:end]) if low <= begin + p <= end - MARGIN}
                cut = next((low + p for p in self.starts(text[low : end + self.overlap]) if low + p in left and not text[low + p - 1].isspace()), None)
                if cut is None:
                    if end >= len(text):
                        return cuts
                    over, end = over * 2, min(len(text), end + over)
            cuts.append(cut)
            begin = cut
        return cuts

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; at most about BATCH characters are encoded at once."""
        total, parts, owner, held = [0] * len(texts), [], [], 0

        def flush() -> None:
            for i, n in zip(owner, self.encode(parts), strict=True):
                total[i] += n
            parts.clear()
            owner.clear()

        for i, text in enumerate(texts):
            cuts = self.splits(text) if self.pieces and len(text) > self.chunk else []
            for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
                parts.append(text[a:b])
                owner.append(i)
                held += b - a
                if held >= BATCH:
                    flush()
                    held = 0
        flush()
        return total


def token_counts(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; one row for each input row. path: of the tokenizer's file, on all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        counter = Counter(path, chunk, overlap)
        for b in batches:
            n = counter.count(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
