"""Alignment of two tokenizers over exact-text classes: each distinct text is tokenised and aligned once.

Texts are shuffled by their full content, so a class of copies is one row with its multiplicity.  Both tokenizers
end a token in front of every space that follows a visible character, so a text is aligned chunk by chunk, and a
chunk that comes again in a block of texts costs a look-up.  A block counts its id pairs, weighted by the copies of
its texts; pairs are summed over blocks, the corpus counts go back to the blocks that hold the pair, and the
measures of a text are sums over its chunks.  A join on the texts' SHA-256 gives them to the documents.

Rows with a null or empty text, or with one that a tokenizer does not render byte for byte (a literal U+2581, for
example), have no tokens.  Repeated rows and null ids stay rows of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import begin_task, kept, prepare, stored, table
from medallion.llm.registry import query
from medallion.llm.tokens import byte_letters

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# A block is closed when its texts or its distinct chunks pass these; one text may take it over the first.
BLOCK_BYTES, BLOCK_CHUNKS = 12 << 20, 250_000
RUN_BYTES = 1 << 20

# Spaces behind a visible character, with something behind them; and the sign of a text with other spaces.
_CUT, _UNEVEN = re.compile(r"(?<=\S) (?=.)", re.S), re.compile(r"\s |^ | $")
TEXT, CHUNKS, PAIR = 0, 1, 2  # kinds of rows that a block gives
_BLOCK = ("kind int, block long, digest string, n_a long, n_b long, n_groups long, groups_sha256 string, ids binary, "
          "links binary, at int, a int, b int, weight long")


def chunks(text: str) -> list[str]:
    """Parts of a text that both tokenizers cut from one another; a space that was in between belongs to the later."""
    return _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")


class Aligner:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task its core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path(b))
        byte = {letter: n for n, letter in byte_letters().items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, n in self.a.get_vocab().items():
            self.a_bytes[n] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode()
                        for n, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]

        # each id as it is shown, inside and at the end of its side of a group
        self.shown = [b"%d%c" % (n, sign) for ids, signs in ((self.a_bytes, b",|"), (self.b_bytes, b",;")) for n in range(len(ids)) for sign in signs]
        self.shown_size = np.array([len(x) for x in self.shown])
        self.a_size, self.b_size = (np.array([len(x) for x in ids]) for ids in (self.a_bytes, self.b_bytes))

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text, by A with a space in front and by B; two empty lists if either fails to render it."""
        spaced = [f" {t}" for t in texts]
        found = list(zip([e.ids for e in self.a.encode_batch(spaced, add_special_tokens=False)], self.b.encode(texts, num_threads=1), strict=True))
        sizes = [self.a_size[list(chain.from_iterable(a for a, _ in found))], self.b_size[list(chain.from_iterable(b for _, b in found))]]
        want = np.array([len(t.encode()) for t in spaced])
        fits = all(np.array_equal(_sums(size, np.array([len(f[side]) for f in found])), want) for side, size in enumerate(sizes))
        whole = "".join(spaced).encode()
        if fits and all(b"".join(map(own.__getitem__, chain.from_iterable(f[side] for f in found))) == whole
                        for side, own in enumerate((self.a_bytes, self.b_bytes))):
            return found
        return [(a, b) if b"".join(map(self.a_bytes.__getitem__, a)) == t.encode() == b"".join(map(self.b_bytes.__getitem__, b)) else ([], [])
                for t, (a, b) in zip(spaced, found, strict=True)]

    def groups(self, found: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Of texts with ``tokens``: numbers of A's and B's ids and of groups; the groups shown; and the linked ids.

        A group ends where a token of each does; texts lie one behind another, so their ends are ends of groups.
        """
        counts = np.array([(len(a), len(b)) for a, b in found], np.int64).reshape(-1, 2)
        ids = [np.fromiter(chain.from_iterable(f[side] for f in found), np.int64, int(counts[:, side].sum())) for side in (0, 1)]
        ends = [np.cumsum(size[i]) for size, i in zip((self.a_size, self.b_size), ids, strict=True)]
        common = ends[0][np.isin(ends[0], ends[1], assume_unique=True)]
        group = [np.searchsorted(common, e) for e in ends]
        last = [np.append(g[1:] != g[:-1], True)[:len(g)] for g in group]
        links = np.stack([i[x] for i, x in zip(ids, last, strict=True)], axis=1)
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        place = np.concatenate([2 * ids[0] + last[0], 2 * len(self.a_bytes) + 2 * ids[1] + last[1]])[order]
        shown = b"".join(map(self.shown.__getitem__, place.tolist()))
        upto = np.concatenate([[0], np.cumsum(self.shown_size[place])])[np.concatenate([[0], np.cumsum(counts.sum(axis=1))])]
        texts = np.repeat(np.arange(len(found)), counts[:, 0])
        sizes = np.column_stack([counts, np.bincount(texts[last[0]], minlength=len(found))])
        return sizes, [shown[i:max(i, j - 1)] for i, j in pairwise(upto.tolist())], links


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` values."""
    ends = np.cumsum(counts)
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[ends] - upto[ends - counts]


@kept
@lru_cache(1)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


class Block:
    """What a block of texts has learned about its chunks."""

    def __init__(self, number: int, own: Aligner):
        self.number, self.own, self.bytes = number, own, 0
        self.known: dict[str, int] = {}
        self.shown: list[bytes] = []      # groups as text, one chunk after another
        self.sizes = np.zeros((0, 3), np.int64)
        self.good: list[bool] = []
        self.pairs: dict[int, int] = {}
        self.links: list[np.ndarray] = []  # of the chunks, as numbers of pairs
        self.weights = np.zeros(0, np.int64)

    def learn(self, new: list[str]) -> None:
        sizes, shown, links = self.own.groups(self.own.tokens(new))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.shown += shown
        self.sizes = np.concatenate([self.sizes, sizes])
        self.good += (sizes[:, 2] > 0).tolist()
        pairs, place = np.unique(links[:, 0] << 32 | links[:, 1], return_inverse=True)
        self.links.append(np.array([self.pairs.setdefault(p, len(self.pairs)) for p in pairs.tolist()], np.uint32)[place])

    def add(self, texts: list[str], digests: list[str], copies: list[int]) -> pa.Table:
        """Align a run of texts; their rows."""
        cut = [chunks(t) for t in texts]
        if new := set().union(*cut).difference(self.known):
            self.learn(sorted(new))
        # what fails in parts is tried whole
        cut = [c if all(map(self.good.__getitem__, map(self.known.__getitem__, c))) else [t] for t, c in zip(texts, cut, strict=True)]
        if new := {c[0] for c in cut if len(c) == 1}.difference(self.known):
            self.learn(sorted(new))
        ids = [np.fromiter(map(self.known.__getitem__, c), np.uint32, len(c)) for c in cut]
        flat, counts = np.concatenate(ids), np.array([len(i) for i in ids])
        self.weights = np.concatenate([self.weights, np.zeros(len(self.known) - len(self.weights), np.int64)])
        np.add.at(self.weights, flat, np.repeat(np.array(copies, np.int64), counts))
        sizes = np.add.reduceat(self.sizes[flat], np.cumsum(counts) - counts)
        shown = [b";".join(map(self.shown.__getitem__, i.tolist())) for i in ids]
        self.bytes += sum(map(len, texts))
        return self.rows(TEXT, len(texts), digest=digests, n_a=sizes[:, 0], n_b=sizes[:, 1], n_groups=sizes[:, 2],
                         groups_sha256=[hashlib.sha256(s).hexdigest() if s else "" for s in shown],
                         ids=[i.tobytes() for i in ids])

    def close(self) -> list[pa.Table]:
        """Links of the chunks, and the pairs with their weights."""
        counts, flat = self.sizes[:, 2].astype(np.uint32), np.concatenate(self.links)
        weight = np.zeros(len(self.pairs), np.int64)
        np.add.at(weight, flat, np.repeat(self.weights, counts))
        ids = np.array(list(self.pairs), np.int64)
        ids = np.stack([ids >> 32, ids & 0xFFFFFFFF], axis=1).astype(np.int32)
        return [self.rows(CHUNKS, 1, ids=[counts.tobytes()], links=[flat.tobytes()]),
                self.rows(PAIR, len(ids), at=np.arange(len(ids), dtype=np.int32), a=ids[:, 0], b=ids[:, 1], weight=weight)]

    def rows(self, kind: int, n: int, **columns) -> pa.Table:
        held = {"kind": np.full(n, kind, np.int32), "block": np.full(n, self.number), **columns}
        return pa.table({f.name: pa.array(held[f.name], f.type) if f.name in held else pa.nulls(n, f.type) for f in _ARROW})


_ARROW = pa.schema([(name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
                    for name, kind in (field.split() for field in _BLOCK.split(", "))])


def blocks(texts: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """Rows of the blocks that the distinct ``texts`` (``text, digest, copies``) are aligned in, stored."""

    def work(batches):
        begin_task(__name__)
        base, block, number = TaskContext.get().partitionId() << 24, None, 0
        for batch in batches:
            texts, digests, copies = (batch.column(c).to_pylist() for c in ("text", "digest", "copies"))
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and size < RUN_BYTES:
                    size += len(texts[end])
                    end += 1
                block = block or Block(base + number, aligner(a, b))
                yield from block.add(texts[first:end], digests[first:end], copies[first:end]).to_batches()
                if block.bytes >= BLOCK_BYTES or len(block.known) >= BLOCK_CHUNKS:
                    for held in block.close():
                        yield from held.to_batches()
                    block, number = None, number + 1
                first = end
        if block:
            for held in block.close():
                yield from held.to_batches()

    prepare(texts.sparkSession)
    return stored(texts.select("text", "digest", "copies").mapInArrow(work, _BLOCK))


def pair_counts(held: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each id pair over the corpus, and whether no pair of its B id has more."""
    counts = held.where(f"kind = {PAIR}").groupBy("a", "b").agg(F.sum("weight").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("_most"))
    # bound: a row of 12 bytes for each id of B's vocabulary
    return counts.join(F.broadcast(most), "b").select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best"))


def measures(held: DataFrame) -> DataFrame:
    """``digest, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum`` of each distinct text."""

    def score(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        count, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
        at = pairs["at"].to_numpy()
        count[at], best[at] = pairs["count"].to_numpy(), pairs["best"].to_numpy().astype(np.int64)
        kind = texts["kind"].to_numpy()
        own = texts.filter(pa.array(kind == CHUNKS))
        sizes, links = (np.frombuffer(own[c][0].as_py(), np.uint32) for c in ("ids", "links"))
        ends = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        texts = texts.filter(pa.array(kind == TEXT))
        ids = [np.frombuffer(x.as_py(), np.uint32) for x in texts["ids"]]
        flat, bounds = np.concatenate(ids), np.cumsum([len(i) for i in ids])
        found = {}
        for name, value in (("n_best", best), ("count_sum", count)):
            upto = np.concatenate([[0], np.cumsum(value[links])])
            of_chunk = upto[ends[1:]] - upto[ends[:-1]]
            found[name] = np.diff(np.concatenate([[0], np.cumsum(of_chunk[flat])])[np.concatenate([[0], bounds])])
        columns = ["digest", "n_a", "n_b", "n_groups", "groups_sha256"]
        return pa.table({c: texts[c] for c in columns} | {"n_links": texts["n_groups"]} | found)

    scored = (held.where(f"kind = {PAIR}").select("block", "at", "a", "b").join(pair_counts(held), ["a", "b"])
              .select(F.col("block").alias("_block"), "at", "count", "best"))
    texts = held.where(f"kind <> {PAIR}").select("kind", "block", "digest", "n_a", "n_b", "n_groups", "groups_sha256", "ids", "links")
    return texts.groupBy("block").cogroup(scored.groupBy("_block")).applyInArrow(
        score, "digest string, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")


def aligned(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> tuple[DataFrame, DataFrame]:
    """The measures of every row of ``docs`` (``doc_id, text``), and the id pairs of the corpus."""
    docs = docs.select("doc_id", F.nullif("text", F.lit("")).alias("text"))
    texts = docs.where("text is not null").groupBy("text").agg(F.count("*").alias("copies"))
    held = blocks(texts.withColumn("digest", F.sha2("text", 256)), a, b)
    found = docs.where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest")).join(measures(held), "digest", "left")
    # rows without text stay out of the join, where they would gather in one task
    found = found.unionByName(docs.where("text is null").select("doc_id"), allowMissingColumns=True)
    long = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return (found.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in long],
                         F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), pair_counts(held))


@query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))[0]
