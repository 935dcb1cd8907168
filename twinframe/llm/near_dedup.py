"""MinHash near-dedup by a chosen-path set similarity join.

A text is lower-cased (A-Z) and read as runs of bytes that are not space or \\t \\n \\v \\f \\r. Its set holds the hashes (64 bits) of its runs of
`shingle` words; a text with fewer words has its whole word sequence as one. Two documents are linked when
100 * intersection >= percent * union, decided on full sets; components of links are the groups, named by their smallest doc_id.

1. Documents with equal sets are one class (its smallest doc_id stands for it), so exact copies cost nothing below. Large classes and nodes are dealt to several
   tasks in every join.
2. Every class walks down `trees` independent trees. At each depth it is dealt to the child of its minwise token under a hash of the tree's
   own; a pair of similarity s shares a child with probability s. Only nodes with more than `small` classes branch on, down to `depth` levels.
3. In every final node all members are compared with its most central one (whose nodes hold the most classes); then, where that left several
   components, each member outside the central one's component is compared with all members outside its own. Pairs that already hang together
   need no comparison, so a large group of near copies costs little more than one comparison each and not all pairs; any other pair of a node is compared.
4. Links are verified where the texts meet: members stream past one text of their partner, in chunks of bounded length. Large nodes are cut into cells of at most
   about BLOCK outside members and CELL members; within a cell all comparisons run on one inverted index, and only links leave it.

The number of trees follows from the least similarity s: a pair of it shares a node of the last depth, the worst case, in at least one tree with probability
1 - MISS. At 0.85 that takes 16 trees, and in nodes of depth 3 or less a pair is then missed with probability 2e-7; at 0.80 it takes 25 trees.

A null text, or one without words, has an empty set: it is linked with nothing and kept. Rows without a doc_id are linked with nothing, have no
component and are kept. Rows that repeat a doc_id are one document, with the links of all its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinframe.llm.common import drop_written, hot_keys, hot_limit, lower_ascii, map_slices, mix, run_hashes, runs, spread_join, text_bytes, text_slices, written

SHINGLE = 5
PERCENT = 85
#: What the pipeline's stage takes.
STAGE_PERCENT = 80
DEPTH, MISS = 6, 6e-4
SMALL = 32
#: Members that stream past one copy of their partner's text.
CHUNK = 64
#: Larger nodes are compared in cells, smaller ones pair by pair.
PAIRWISE = 8
BLOCK, CELL = 256, 1024
#: Members of a node that one task of a join by nodes takes.
PORTION = 4096
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def shingles(rows: pa.RecordBatch, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every row of a batch, end to end and sorted in each row, and their n + 1 offsets."""
    data, offsets = text_bytes(rows.column(rows.schema.get_field_index("text")))
    data = lower_ascii(data)
    starts, ends = runs(_IS_WORD[data], offsets)
    words = run_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    out, cut = [], [0]
    with np.errstate(over="ignore"):
        factor = mix(np.arange(size, dtype=np.uint64), 5) | np.uint64(1)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            n = b - a
            if n >= size:
                total = words[a : b - size + 1] * factor[0]
                for i in range(1, size):
                    total += words[a + i : b - size + 1 + i] * factor[i]
                out.append(np.unique(mix(total)))
            elif n:
                out.append(mix((words[a:b] * factor[:n]).sum(dtype=np.uint64)[None], 100 + n))
            cut.append(cut[-1] + (len(out[-1]) if n else 0))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(cut)


def trees_for(percent: int, depth: int = DEPTH, miss: float = MISS) -> int:
    """How many trees find a pair of the least similarity in a node of the last depth but for `miss`."""
    same = (percent / 100) ** depth
    return 1 if same >= 1 else math.ceil(math.log(miss) / math.log1p(-same))


def sketches(docs: DataFrame, shingle: int = SHINGLE, trees: int = 16, depth: int = DEPTH) -> DataFrame:
    """doc_id, mark (the text's hash), n (set size), hi and lo (a 128-bit hash of the set) and tokens (the minwise token of each tree and depth)."""

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        flat, cut = shingles(rows, shingle)
        n = np.diff(cut)
        some = np.flatnonzero(n)
        ids = np.zeros((rows.num_rows, 2), np.int64)
        tokens = np.zeros((rows.num_rows, trees * depth), np.int32)
        if len(some):
            at = cut[some]
            with np.errstate(over="ignore"):
                for k in range(2):
                    ids[some, k] = np.add.reduceat(mix(flat, 900 + k), at).astype(np.int64)
                turns = mix(np.arange(trees * depth, dtype=np.uint64), 11) | np.uint64(1)
                for k in range(trees * depth):
                    tokens[some, k] = (mix(np.minimum.reduceat(flat * turns[k], at)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(tokens.ravel()), trees * depth).cast(pa.list_(pa.int32()))
        return pa.record_batch([rows.column(0), rows.column(2), pa.array(n), pa.array(ids[:, 0]), pa.array(ids[:, 1]), lists], ["doc_id", "mark", "n", "hi", "lo", "tokens"])

    return map_slices(docs, ["doc_id", "text", F.xxhash64("text").alias("mark")], step, "doc_id long, mark long, n long, hi long, lo long, tokens array<int>")


def nodes(classes: DataFrame, total: int, trees: int, depth: int = DEPTH, small: int = SMALL, into: list[DataFrame] | None = None) -> DataFrame:
    """The final nodes with two classes or more: node, id, doc, n, members. total: a bound on the number of classes."""
    active = classes.select("id", "doc", "n", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "tokens")
    active = active.select("id", "doc", "n", "tree", F.slice("tokens", F.col("tree") * depth + 1, depth).alias("tokens"))
    limit, out = hot_limit(trees * total), None
    for d in range(1, depth + 1):
        keyed = active.withColumn("node", F.xxhash64("tree", F.slice("tokens", 1, d), F.lit(d)))
        sizes = written(keyed.groupBy("node").agg(F.count("*").alias("members")).where("members > 1"), f"sizes-{d}", total, into)
        met = spread_join(keyed, sizes, ["node"], hot_keys(sizes, ["node"], "members", limit), ["id"])
        level = written(met.select("node", "id", "doc", "n", "tree", *(["tokens"] if d < depth else []), "members"), f"nodes-{d}", into=into)
        done = (level if d == depth else level.where(F.col("members") <= small)).select("node", "id", "doc", "n", "members")
        out = done if out is None else out.unionByName(done)
        if d == depth:
            break
        active = level.where(F.col("members") > small).select("id", "doc", "n", "tree", "tokens")
        if active.isEmpty():
            break
    return out


def _portions() -> F.Column:
    return F.ceil(F.col("members") / PORTION).cast("int")


def by_node(rows: DataFrame, one: DataFrame) -> DataFrame:
    """rows (node, id, members, ...) with one's row of their node (node, members, ...); a node's rows are dealt in portions."""
    left = rows.withColumn("_portion", F.pmod(F.xxhash64("id", F.lit(7)), _portions()).cast("int"))
    return left.join(one.withColumn("_portion", F.explode(F.sequence(F.lit(0), _portions() - 1))).drop("members"), ["node", "_portion"]).drop("_portion")


def _alike(x: str, y: str, percent: int) -> F.Column:
    """Set sizes that allow a link at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def verified(pairs: DataFrame, texts: DataFrame, limit: int, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The doc_ids of the pairs (a, doc_a, b, doc_b) whose full sets are linked. texts: id, text. limit: pairs of one `a` that a task takes."""
    load = pairs.groupBy("a").agg(F.count("*").alias("load"))
    # the text of `a` goes to as many chunks as members go to each, where there are many
    chunks = F.greatest(F.ceil(F.col("load") / F.greatest(F.lit(CHUNK), F.ceil(F.sqrt("load")))), F.lit(1))
    salted = spread_join(pairs, load, ["a"], hot_keys(load, ["a"], "load", limit), ["b"]).select("a", "doc_a", "b", "doc_b", F.pmod(F.xxhash64("b"), chunks).alias("chunk"))
    wanted = salted.select("a", "chunk", F.lit(1).alias("member"), F.col("b").alias("id"), F.col("doc_b").alias("doc")).unionByName(
        salted.select("a", "chunk", F.lit(0).alias("member"), F.col("a").alias("id"), F.col("doc_a").alias("doc")).distinct()
    )
    met = wanted.join(texts, "id").select("a", "chunk", "member", "doc", "id", "text")
    met = met.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whose, own_doc, base = None, None, None
        for batch in batches:
            for rows in text_slices(batch):
                flat, cut = shingles(rows, shingle)
                a, chunk, member, doc = (rows.column(k).to_pylist() for k in range(4))
                left, right = [], []
                for r in range(rows.num_rows):
                    own = flat[cut[r] : cut[r + 1]]
                    if not member[r]:
                        whose, own_doc, base = (a[r], chunk[r]), doc[r], own
                    elif whose == (a[r], chunk[r]):
                        both = len(np.intersect1d(base, own, assume_unique=True))
                        if both and 100 * both >= percent * (len(base) + len(own) - both):
                            left.append(own_doc)
                            right.append(doc[r])
                yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def led(final: DataFrame) -> DataFrame:
    """final with each node's leader, its doc and n: the member whose nodes hold the most classes together, then the smallest id."""
    weight = final.groupBy("id").agg(F.sum("members").alias("weight"))
    weighed = final.join(weight, "id")
    lead = F.struct((-F.col("weight")).alias("w"), F.col("id").alias("i"), F.col("n").alias("k"), F.col("doc").alias("d"))
    first = weighed.groupBy("node").agg(F.min(lead).alias("first"), F.max("members").alias("members"))
    return by_node(weighed, first).select("node", "id", "doc", "n", "members", F.col("first.i").alias("leader"), F.col("first.d").alias("leader_doc"), F.col("first.k").alias("leader_n"))


def cell_links(open_: DataFrame, texts: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Links between outside members and members of other components of large nodes, one for each outside member and component of a cell.

    open_: node, id, doc, component, outside, members, outsiders (how many of each the node has). Links are pairs of doc_ids.
    """
    blocks = F.ceil(F.col("outsiders") / BLOCK).cast("int")
    cells = F.ceil(F.col("members") / CELL).cast("int")
    own = open_.where("outside").select("node", F.pmod(F.xxhash64("id"), blocks).alias("block"), F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"), F.lit(0).alias("side"), "id", "doc", "component")
    other = open_.select("node", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), cells).cast("int").alias("cell"), F.lit(1).alias("side"), "id", "doc", "component")
    met = own.unionByName(other).join(texts, "id").select("node", "block", "cell", "side", "doc", "component", "id", "text")
    met = met.repartition("node", "block", "cell").sortWithinPartitions("node", "block", "cell", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index, told = None, [], None, set()
        for batch in batches:
            for rows in text_slices(batch):
                flat, cut = shingles(rows, shingle)
                keys = list(zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True))
                side, ids, component = (rows.column(k).to_pylist() for k in (3, 4, 5))
                left, right = [], []
                for r in range(rows.num_rows):
                    mine = flat[cut[r] : cut[r + 1]]
                    if keys[r] != now:
                        now, held, index, told = keys[r], [], None, set()
                    if not side[r]:
                        held.append((ids[r], component[r], mine))
                        continue
                    if index is None:
                        index = _inverted([h[2] for h in held])
                    both = _common(index, mine, len(held))
                    linked = np.flatnonzero((both > 0) & (100 * both >= percent * (index[3] + len(mine) - both)))
                    for k in linked.tolist():
                        own_id, own_component, _ = held[k]
                        if own_component != component[r] and (k, component[r]) not in told:
                            told.add((k, component[r]))
                            left.append(own_id)
                            right.append(ids[r])
                yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _inverted(sets: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Distinct hashes, where their owners begin, the owners, and the sets' sizes."""
    size = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    by = np.argsort(flat, kind="stable")
    value, first = np.unique(flat[by], return_index=True)
    return value, np.append(first, len(flat)), np.repeat(np.arange(len(sets)), size)[by], size


def _common(index: tuple[np.ndarray, ...], own: np.ndarray, n: int) -> np.ndarray:
    """How many hashes of `own` each set of the index holds."""
    value, first, owner, _ = index
    if not len(value) or not len(own):
        return np.zeros(n, np.int64)
    at = np.minimum(np.searchsorted(value, own), len(value) - 1)
    at = at[value[at] == own]
    count = first[at + 1] - first[at]
    where = np.repeat(first[at] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return np.bincount(owner[where], minlength=n)


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """id and component (its smallest id) of every id in links (a, b), by alternating large-star and small-star rounds until nothing moves.

    With `rounds`, it ends after so many: what then shares a name is connected, but some components may still go by several names.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    bound = edges.count()  # no round makes more edges
    mark, done = None, 0
    while rounds is None or done < rounds:
        done += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        old, edges = edges, written(small.where("u <> v").distinct(), "edges", bound)
        drop_written(old)
        if rounds is not None:
            continue
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    own = edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")))
    return own.groupBy("id").agg(F.min("component").alias("component"))


def one_name(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the documents that stand for the classes of one repeated doc_id. rows: doc_id, hi, lo."""
    many = rows.groupBy("doc_id").agg(F.min("hi").alias("x"), F.max("hi").alias("y")).where("x <> y").select("doc_id")
    own = rows.join(many, "doc_id", "left_semi").select("doc_id", "hi", "lo").distinct().join(classes.select("hi", "lo", "doc"), ["hi", "lo"]).select("doc_id", "doc")
    return own.select(F.col("doc_id").alias("a"), F.col("doc").alias("b")).distinct()


def groups(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, trees: int | None = None, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    done: list[DataFrame] = []
    trees = trees or trees_for(percent, depth)
    sets = written(sketches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle, trees, depth), "sketches")
    total = sets.count()
    limit = hot_limit(trees * total)
    some = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "mark", "n", "tokens")).alias("first"), F.count("*").alias("copies"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("id"), "hi", "lo", F.col("first.doc_id").alias("doc"), F.col("first.mark").alias("mark"), F.col("first.n").alias("n"), F.col("first.tokens").alias("tokens"), "copies"), "classes")
    repeated = written(one_name(some, classes), "one-name", total, done)
    final = written(led(nodes(classes, total, trees, depth, small, done)), "nodes", trees * total, done)
    met = classes.join(final.select("id").distinct(), "id", "left_semi").select("id", F.col("doc").alias("doc_id"), "mark")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").join(met, ["doc_id", "mark"])
    texts = written(texts.dropDuplicates(["doc_id", "mark"]).select("id", "text"), "texts", into=done)
    first = final.where((F.col("id") != F.col("leader")) & _alike("n", "leader_n", percent)).select(F.col("leader").alias("a"), F.col("leader_doc").alias("doc_a"), F.col("id").alias("b"), F.col("doc").alias("doc_b")).distinct()
    links = written(verified(first, texts, limit, percent, shingle), "links-1", trees * total, done)
    so_far = components(links, 2)  # names need only be right, not final, to spare comparisons

    named = final.join(so_far.withColumnRenamed("id", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    main = F.max(F.when(F.col("id") == F.col("leader"), F.col("component")))
    split = named.groupBy("node").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), main.alias("main"), F.max("members").alias("members")).where("lo <> hi").select("node", "main", "members")
    # the leader has been compared with all; two members are done with that
    apart = by_node(named, split).where((F.col("id") != F.col("leader")) & (F.col("members") > 2))
    open_ = written(apart.select("node", "id", "doc", "n", "component", "members", (F.col("component") != F.col("main")).alias("outside")), "open", trees * total, done)
    pairwise = open_.where(F.col("members") <= PAIRWISE)
    one, two = (pairwise.select("node", *(F.col(c).alias(f"{p}_{c}") for c in ("id", "doc", "n", "component", "outside"))) for p in ("x", "y"))
    unlinked = (F.col("x_component") != F.col("y_component")) & _alike("x_n", "y_n", percent) & (~F.col("y_outside") | (F.col("x_id") < F.col("y_id")))
    met = one.where("x_outside").join(two, "node").where(unlinked)
    ordered = F.col("x_id") < F.col("y_id")
    ends = [F.when(ordered, F.col(f"{p}_{c}")).otherwise(F.col(f"{q}_{c}")).alias(name) for p, q, c, name in (("x", "y", "id", "a"), ("x", "y", "doc", "doc_a"), ("y", "x", "id", "b"), ("y", "x", "doc", "doc_b"))]
    second = met.select(*ends).distinct()
    large = open_.where(F.col("members") > PAIRWISE)
    count = large.groupBy("node").agg(F.count_if("outside").alias("outsiders"), F.max("members").alias("members")).where("outsiders > 0")
    more = written(verified(second, texts, limit, percent, shingle).unionByName(cell_links(by_node(large, count), texts, percent, shingle)), "links-2", trees * total, done)
    whole = components(links.unionByName(more).unionByName(repeated))
    drop_written(*done)  # what follows reads the sketches, the classes and the last edges only

    named = classes.select("hi", "lo", "doc").join(whole.withColumnRenamed("id", "doc"), "doc", "left").select("hi", "lo", F.coalesce("component", "doc").alias("component"))
    out = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("hi")).alias("hi"), F.when(F.col("n") > 0, F.col("lo")).alias("lo"))
    out = spread_join(out, named, ["hi", "lo"], hot_keys(classes, ["hi", "lo"], "copies", hot_limit(total)), ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, percent: int = STAGE_PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """docs (same columns) with one document, the one of the smallest doc_id, for each group; rows that repeat that doc_id all stay."""
    gone = groups(docs, percent, shingle).where("NOT kept").select(F.col("doc_id").alias("__twinframe_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__twinframe_gone"], "left_anti")
