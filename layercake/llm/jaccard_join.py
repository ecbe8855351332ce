"""N-gram Jaccard join by rare-first prefix filtering.

1. Every text becomes a set of hashed word n-grams. A packed exchange counts in how many
   chunk-wise distinct sets each n-gram lies; the order (count, hash) puts rare ones first.
2. Two sets with Jaccard similarity >= t share an n-gram among the first
   ``n - ceil(t * n) + 1`` of each. N-grams that one set alone has cannot be shared, so
   that most texts leave here. Equal sets are one class from here on.
3. Sets that share a prefix n-gram meet under the smallest class that has it, their
   leader. One family (leader and members) holds every candidate pair of its n-grams
   once, however many n-grams a pair shares. Within a family, length, positional and
   suffix filters go before the exact intersection; pairs that earlier links connect
   are not compared again.
4. Large families are dealt over blocks of bounded size, each with the leader. What is
   still apart from the family's main component after that is compared with all blocks.
   So every pair of different classes is either connected or compared: no link is lost,
   and a group of copies costs about its size instead of its square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm import exchange as X
from layercake.llm.components import connected_components
from layercake.llm.shipping import ship
from layercake.llm.words import Words, find_words, mix, place_factor, text_buffer, window_hashes
from layercake.session import write_scratch

#: Members of a family compared in one task: a 48th of it within these bounds.
BLOCK_MEMBERS = (32, 1024)
_SETS = "doc_id long, sig binary, n long, grams binary"


def ngram_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ordered by text and hash, and their texts.
    A text with 1 to k - 1 words has its whole sequence as one n-gram."""
    keys, at = window_hashes(words, k)
    text = words.text_of[at]
    counts = words.counts
    few = np.flatnonzero((counts > 0) & (counts < k))
    whole = np.zeros(len(few), np.uint64)
    for j in range(k - 1):
        has = counts[few] > j
        whole[has] += words.hashes[words.bounds[few[has]] + j] * place_factor(j)
    keys, text = np.concatenate([keys, mix(whole + counts[few].astype(np.uint64))]), np.concatenate([text, few])
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], text[new]


class _Sets:
    """The n-gram sets of one chunk; ``first``: the first text of each distinct set."""

    def __init__(self, docs: pa.Table, k: int):
        words = find_words(*text_buffer(docs["__text"]), fold_case=True)
        self.keys, self.text = ngram_sets(words, k)
        self.sizes = np.bincount(self.text, minlength=docs.num_rows)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        full = self.sizes > 0
        sums = np.zeros((docs.num_rows, 2), np.uint64)
        if full.any():
            for i, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
                sums[full, i] = np.add.reduceat(mix(self.keys ^ np.uint64(salt)), self.bounds[:-1][full])
        self.sigs = sums
        first = np.unique(sums.view("V16").reshape(-1), return_index=True)[1] if len(sums) else np.zeros(0, np.int64)
        self.first = np.zeros(docs.num_rows, bool)
        self.first[first] = True
        self.first &= full


def _prefix(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def link_block(sigs: list[bytes], grams: list[bytes], percent: int, labels: list | None = None, rest: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets of one block: pairs of indices, each verified exactly
    (100 * intersection >= percent * union). ``labels``: components known before;
    ``rest``: only pairs with at least one such row are compared."""
    m = len(sigs)
    sizes = np.array([len(g) // 9 for g in grams], np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    keys = [np.frombuffer(grams[i], np.uint64, len(grams[i]) // 9) for i in order]
    counts = [np.frombuffer(grams[i], np.uint8, offset=len(grams[i]) // 9 * 8) for i in order]
    key, count = np.concatenate(keys), np.concatenate(counts)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # n-grams numbered in the global order, rare first
    by = np.lexsort((key, count))
    new = np.ones(len(key), bool)
    new[1:] = key[by][1:] != key[by][:-1]
    rank = np.empty(len(key), np.int64)
    rank[by] = np.cumsum(new) - 1
    width = int(new.sum())
    owner = np.repeat(np.arange(m), sizes)
    flat = rank + owner * width
    # index of the prefixes by n-gram
    prefix = _prefix(sizes, percent)
    place = np.arange(len(key)) - starts[owner]
    inside = np.flatnonzero(place < prefix[owner])
    inside = inside[np.lexsort((owner[inside], rank[inside]))]
    index_rank, index_owner, index_place = rank[inside], owner[inside], place[inside]

    known = {}
    group = np.array([known.setdefault(labels[i] if labels else int(i), len(known)) for i in order])
    special = rest[order] if rest is not None else np.ones(m, bool)
    mark = np.zeros(width, bool)
    links: list[tuple[int, int]] = []
    for x in range(1, m):
        nx = int(sizes[x])
        own = rank[starts[x] : starts[x + 1]]
        low = np.searchsorted(index_rank, own[: prefix[x]], side="left")
        high = np.searchsorted(index_rank, own[: prefix[x]], side="right")
        spans = high - low
        where = np.repeat(low - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
        other = index_owner[where]
        # sets before x that are large enough (length filter) and not yet connected
        use = (other < x) & (sizes[other] * 100 >= percent * nx) & (group[other] != group[x]) & (special[x] | special[other])
        if not use.any():
            continue
        other, at_other = other[use], index_place[where][use]
        at_own = np.repeat(np.arange(len(spans)), spans)[use]
        shared = np.bincount(other, minlength=x)
        last_own, last_other = np.zeros(x, np.int64), np.zeros(x, np.int64)
        last_own[other], last_other[other] = at_own, at_other
        y = np.flatnonzero(shared)
        need = -(-percent * (nx + sizes[y]) // (100 + percent))
        # positional filter: what may follow the last shared prefix n-gram
        left_own, left_other = nx - last_own[y] - 1, sizes[y] - last_other[y] - 1
        fits = shared[y] + np.minimum(left_own, left_other) >= need
        y, need = y[fits], need[fits]
        # suffix filter: pivots cut both suffixes; each part shares at most its shorter side
        cuts = np.unique(np.linspace(0, nx, 9).astype(np.int64))[1:-1]
        if len(y) and len(cuts):
            in_other = np.searchsorted(flat, y[:, None] * width + own[cuts][None, :]) - starts[y][:, None]
            edge_own = np.maximum(np.concatenate([np.zeros((len(y), 1), np.int64), np.broadcast_to(cuts, (len(y), len(cuts))), np.full((len(y), 1), nx)], 1), (last_own[y] + 1)[:, None])
            edge_other = np.maximum(np.concatenate([np.zeros((len(y), 1), np.int64), in_other, sizes[y][:, None]], 1), (last_other[y] + 1)[:, None])
            most = shared[y] + np.minimum(np.diff(edge_own, axis=1), np.diff(edge_other, axis=1)).sum(1)
            y, need = y[most >= need], need[most >= need]
        if not len(y):
            continue
        mark[own] = True
        spans = sizes[y]
        begin = np.concatenate([[0], np.cumsum(spans)[:-1]])
        where = np.repeat(starts[y] - begin, spans) + np.arange(spans.sum())
        common = np.add.reduceat(mark[rank[where]].astype(np.int64), begin)
        mark[own] = False
        for other_set in y[common >= need]:
            if group[other_set] != group[x]:
                links.append((int(order[x]), int(order[other_set])))
                group[group == group[other_set]] = group[x]
    return links


def _links_table(table: pa.Table, percent: int) -> pa.Table:
    sigs, grams = table["sig"].to_pylist(), table["grams"].to_pylist()
    known = table["root"].to_pylist() if "root" in table.column_names else None
    rest = np.array(table["is_rest"].to_pylist(), bool) if known else None
    links = link_block(sigs, grams, percent, known, rest)
    return pa.table({"a": pa.array([sigs[i] for i, _ in links], pa.binary()), "b": pa.array([sigs[j] for _, j in links], pa.binary())})


def _size_limits(size):
    low, high = BLOCK_MEMBERS
    return F.least(F.lit(high), F.greatest(F.lit(low), (size / 48).cast("long"))).cast("long")


def set_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``: set signatures) that connect all sets of ``sets`` (sig, grams)
    whose similarity chains connect them."""
    spark = sets.sparkSession
    classes = write_scratch(sets.where("grams IS NOT NULL").groupBy("sig").agg(F.first("grams").alias("grams")), "classes")

    def postings(batches):
        for batch in batches:
            sigs, tokens, own = batch.column(0).to_pylist(), [], []
            for sig, gram in zip(sigs, batch.column(1).to_pylist(), strict=True):
                n = len(gram) // 9
                keys, counts = np.frombuffer(gram, np.int64, n), np.frombuffer(gram, np.uint8, offset=n * 8)
                p = _prefix(n, percent)
                shared = keys[:p][counts[:p] > 1]
                tokens.append(shared)
                own += [sig] * len(shared)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *tokens])), pa.array(own, pa.binary())], ["token", "sig"])

    posted = classes.select("sig", "grams").mapInArrow(postings, "token long, sig binary").withColumn("rank", F.xxhash64("sig"))
    leaders = write_scratch(posted.groupBy("token").agg(F.min("rank").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "leaders")
    family = write_scratch(posted.join(leaders, "token").select("leader", "sig", "rank").distinct(), "families")
    blocks = write_scratch(family.groupBy("leader").agg(F.count(F.lit(1)).alias("size")).withColumn("blocks", F.ceil(F.col("size") / _size_limits(F.col("size"))).cast("int")), "family_sizes")

    dealt = family.join(blocks, "leader").withColumn("own", F.pmod(F.xxhash64("sig", F.lit(7)), F.col("blocks")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    first = dealt.withColumn("block", F.explode(F.when(F.col("rank") == F.col("leader"), everywhere).otherwise(F.array("own"))))
    found = first.select("leader", "block", "sig").join(classes, "sig").groupBy("leader", "block").applyInArrow(lambda t: _links_table(t, percent), "a binary, b binary")
    found = write_scratch(found, "links")
    large = blocks.where("blocks > 1")
    if large.isEmpty():
        return found

    roots = write_scratch(connected_components(found), "roots").select(F.col("node").alias("sig"), "root")
    members = dealt.where("blocks > 1").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig")).select("leader", "sig", "root", "own", "blocks", "size")
    members = write_scratch(members, "members")
    main = members.groupBy("leader", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("leader").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("n"))
    main = write_scratch(main, "main")
    members = members.join(main, "leader").withColumn("is_rest", F.col("root") != F.col("main"))
    left = F.col("size") - F.col("n")
    members = members.withColumn("rest_blocks", F.ceil(left / _size_limits(F.col("size"))).cast("int")).where("rest_blocks > 0")
    targets = members.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))).withColumn("block", F.col("own")).withColumn("is_rest", F.lit(False))
    probes = members.where("is_rest").withColumn("block", F.explode(everywhere)).withColumn("part", F.pmod(F.xxhash64("sig", F.lit(11)), F.col("rest_blocks")).cast("int"))
    columns = ["leader", "part", "block", "sig", "root", "is_rest"]
    second = targets.select(columns).unionByName(probes.select(columns)).join(classes, "sig")
    more = second.groupBy("leader", "part", "block").applyInArrow(lambda t: _links_table(t, percent), "a binary, b binary")
    return write_scratch(found.unionByName(more), "all_links")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row: the smallest id
    reachable by links; two texts link when the Jaccard similarity of their sets of
    ``shingle``-word n-grams (A-Z lower-cased) is at least ``percent`` / 100.

    Null, empty and blank texts have no n-grams and link with nothing; a text with fewer
    words has its whole sequence as one n-gram. Equal texts are one class. A null id is
    never a component's id unless the whole component has no other. Repeated rows stay
    repeated; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    layout = X.layout_of(docs, text_col)
    bits, buckets = layout.short_bits, layout.buckets
    rows = X.dealt(docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text")), layout, ["__id", "__text"])
    by_chunk = rows.groupBy("chunk")

    def send_counts(docs: pa.Table) -> pa.Table:
        sets = _Sets(docs, shingle)
        keys, counts = np.unique(X.short(sets.keys[sets.first[sets.text]], bits), return_counts=True)
        return X.blocks_table(docs["chunk"][0].as_py(), keys, [np.minimum(counts, 255).astype(np.uint8)], bits, buckets)

    def add_counts(blocks: pa.Table) -> pa.Table:
        found = X.gather(blocks, ["u1"])
        counts = found.values[0][found.order].astype(np.int64)
        total = np.add.reduceat(counts, found.firsts) if len(counts) else counts
        return X.answers_table(found, blocks["bucket"][0].as_py(), (X.pack([a]) for a in found.back(np.minimum(total, 255).astype(np.uint8))))

    def order_sets(docs: pa.Table, answers: pa.Table) -> pa.Table:
        sets = _Sets(docs, shingle)
        used = sets.first[sets.text]
        keys, text = sets.keys[used], sets.text[used]
        place = np.unique(X.short(keys, bits), return_inverse=True)[1]
        counts = X.answered(answers, ["u1"])[0][place]
        order = np.lexsort((keys, counts, text))
        keys, counts = keys[order], counts[order]
        bounds = np.searchsorted(text, np.arange(docs.num_rows + 1))
        grams: list[bytes | None] = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            n = int(b - a)
            shared = n > 0 and (counts[a : a + _prefix(n, percent)] > 1).any()
            grams.append(keys[a:b].tobytes() + counts[a:b].tobytes() if shared else None)
        sigs = [s.tobytes() if n else None for s, n in zip(sets.sigs, sets.sizes, strict=True)]
        return pa.table({"doc_id": docs["__id"], "sig": pa.array(sigs, pa.binary()), "n": pa.array(sets.sizes.astype(np.int64)), "grams": pa.array(grams, pa.binary())})

    answers = by_chunk.applyInArrow(send_counts, X.BLOCKS).groupBy("bucket").applyInArrow(add_counts, X.ANSWERS)
    sets = write_scratch(by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(order_sets, _SETS), "sets")
    roots = connected_components(set_links(sets.select("sig", "grams"), percent))
    thin = sets.where("n > 0").select("doc_id", "sig", "n")
    rooted = thin.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    smallest = write_scratch(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "smallest")
    linked = rooted.join(smallest, "root").select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
    alone = sets.where("n = 0").select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
