"""Near-duplicate documents by weighted MinHash of word shingles.

Signatures are DartMinHash: every unit of weight of every shingle throws darts at the rank axis, a Poisson process whose arrivals are
hashes of the shingle, so equal regions of two documents receive equal darts. Each dart falls on one coordinate of the signature; the earliest dart per coordinate is
kept. The number of darts is about k ln k whatever the document's length, so the cost is linear in length plus k ln k.

Signatures are cut into bands. Documents that share a band are candidates; each bucket's members are verified against one leader, the
member with the most company, by their exact weighted Jaccard similarity. What the leaders leave apart is compared too, between groups only, so no link of
a bucket is lost: near copies of one text (members of one home) by blocks, of which only connecting links leave the task; the few other pairs one by one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from layerloom.llm import shingles as S
from layerloom.llm.common import parts_for, whole_text, written
from layerloom.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
MEMBERS_PER_BLOCK = 512
# Ids, at most, that are sent to every task in place of a shuffle of the documents.
IDS_SENT = 1_000_000
BANDS, ROWS = 30, 6  # a pair of similarity 0.8 shares a band with probability 0.9999


def signatures(owner: np.ndarray, ids: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k signatures of weighted sets given as unit elements. Rows of empty sets keep the largest value."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    result = np.full((n, k), none, np.uint64)
    weight = np.bincount(owner, minlength=n).astype(float)
    limit = k * (math.log(k) + 4) / np.maximum(weight, 1)  # ranks up to here hold that many darts, as expected
    todo = np.ones(n, bool)
    while True:
        live = todo[owner]
        who, what, rank, throw = owner[live], ids[live], np.zeros(int(live.sum())), 0
        flat = result.reshape(-1)
        while len(who):
            dart = S.mixed(what ^ S.mixed(np.full(1, 2 * throw + 1, np.uint64)))
            rank = rank - np.log((dart >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54)
            keep = rank < limit[who]
            who, what, rank, dart = who[keep], what[keep], rank[keep], S.mixed(dart[keep])
            place = who * k + (dart % np.uint64(k)).astype(np.int64)
            value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | dart >> np.uint64(32)
            np.minimum.at(flat, place, value)
            throw += 1
        todo = (result == none).any(axis=1) & (weight > 0)
        if not todo.any():
            return result
        result[todo] = none
        limit[todo] *= 2


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit number per band, different bands having different numbers."""
    out = np.zeros((len(signature), bands), np.uint64)
    for b in range(bands):
        total = S.mixed(np.full(len(signature), b + 1, np.uint64))
        for r in range(rows):
            total = S.mixed(total ^ signature[:, b * rows + r])
        out[:, b] = total
    return out.view(np.int64)


def _slices(batches: Iterator[pd.DataFrame], rows: int = 200) -> Iterator[pd.DataFrame]:
    """Smaller batches: the arrays of darts are many times the size of the texts."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


def _signed(documents: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            texts = batch.text.tolist()
            owner, ids = S.elements(*S.shingles(texts, shingle))
            found = band_hashes(signatures(owner, ids, len(texts), bands * rows), bands, rows)
            has = np.bincount(owner, minlength=len(texts)) > 0
            keys = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            values = [list(f) if h else [] for f, h in zip(found, has)]
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "copy": keys, "bands": values})

    return documents.mapInPandas(run, "doc_id long, copy binary, bands array<long>")


def _unpacked(data: bytes) -> np.ndarray:
    """Elements of a set, sorted; five bytes of hash each."""
    raw = np.zeros((len(data) // 5, 8), np.uint8)
    raw[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return raw.reshape(-1).view("<u8")


def _sets(documents: DataFrame, wanted: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """rep and ``held``, the elements of its weighted set, for the wanted nodes. Each is read from the one document that stands for the text. Few nodes are sent to
    the documents, which then stay where they are; beyond the bound both sides are shuffled."""
    named = nodes.select("rep", F.col("first").alias("doc_id"), "copy").join(wanted.distinct(), "rep")
    named = written(named, "minhash-wanted")
    n = named.count()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            owner, elements = S.elements(*S.shingles(batch.text.tolist(), shingle))
            cuts = np.searchsorted(owner, np.arange(1, len(batch)))
            small = [np.unique(x >> np.uint64(24)) for x in np.split(elements, cuts)]
            packed = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for x in small]
            yield pd.DataFrame({"rep": batch.rep, "held": packed})

    chosen = documents.withColumn("copy", text_hash("text")).join(F.broadcast(named) if n <= IDS_SENT else named, ["doc_id", "copy"])
    held = written(chosen.select("rep", "text").mapInPandas(run, "rep long, held binary"), "minhash-sets")
    return held if held.count() == n else held.dropDuplicates(["rep"])  # repeated rows


def _verified(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) of nodes whose weighted Jaccard similarity reaches the bound."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch.held_a, batch.held_b):
                x, y = _unpacked(x), _unpacked(y)
                possible = min(len(x), len(y)) >= similarity * max(len(x), len(y))
                common = len(np.intersect1d(x, y, assume_unique=True)) if possible else 0
                good.append(common >= similarity * (len(x) + len(y) - common) and common > 0)
            yield batch.loc[good, ["a", "b"]]

    first = held.select(F.col("rep").alias("a"), F.col("held").alias("held_a"))
    second = held.select(F.col("rep").alias("b"), F.col("held").alias("held_b"))
    return pairs.join(second, "b").join(first, "a").mapInPandas(compare, "a long, b long")


def _common_elements(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the elements that several sets hold."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, (_, column) = owner[shared], np.unique(column[shared], return_inverse=True)
    width = int(column.max()) + 1 if len(column) else 0
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    step = max(64, (1 << 22) // n)
    for low in range(0, width, step):  # a slice of the columns at a time
        here = slice(*np.searchsorted(column, [low, low + step]))
        held = np.zeros((n, min(step, width - low)), np.float32)
        held[owner[here], column[here] - low] = 1
        common += held @ held.T
    return common


def _spanning(ids: np.ndarray, groups: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links between different groups, as few as connect what is linked."""
    sizes = np.array([len(s) for s in sets], np.float32)
    common = _common_elements(sets)
    near = (common > 0) & (common >= similarity * (sizes[:, None] + sizes[None] - common) - 1e-3)
    left, right = np.nonzero(np.triu(near & (groups[:, None] != groups[None]), 1))
    parent = {g: g for g in groups.tolist()}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(left.tolist(), right.tolist()):
        a, b = find(groups[i]), find(groups[j])
        if a != b:
            parent[b] = a
            out.append((int(ids[i]), int(ids[j])))
    return out


def _within_homes(placed: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Links between components among the members of one home (rep, home, component): every block of members against every other, all pairs of
    two blocks at once by matrix products. Only links that connect something leave a task."""
    homes = placed.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    homes = homes.where("low < high").select("home", F.ceil(F.col("n") / MEMBERS_PER_BLOCK).cast("int").alias("blocks"))
    rows = placed.join(homes, "home").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.join(held, "rep")
    sent = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("home", "rep", "component", "held", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    parts = 4 * parts_for(placed)
    sent = sent.withColumn("part", F.pmod(F.xxhash64("home", "low", "high"), F.lit(parts)).cast("int"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for _, block in part.groupby(["home", "low", "high"], sort=False):
            if block.component.nunique() > 1:
                out += _spanning(block.rep.to_numpy(), block.component.to_numpy(), [_unpacked(h) for h in block.held], similarity)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return sent.groupBy("part").applyInPandas(run, "a long, b long")


def text_hash(column: str) -> Column:
    """The hash by which equal texts are known, as Python computes it too."""
    return F.unhex(F.md5(F.col(column).cast("binary")))


def _classes(texts: DataFrame, shingle: int, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(every row's doc_id and copy, its text's hash; copy, first and root of every text with words and a known id). ``first`` is the smallest id that has the
    text, ``root`` the (first, copy) that stands for the text's class: the smallest."""
    signed = written(_signed(texts, shingle, bands, rows), "minhash-signed")
    named = signed.where(F.col("doc_id").isNotNull() & (F.size("bands") > 0))
    # Equal texts are one node, so a group of copies is one row from here on.
    stand = named.groupBy("copy").agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("first"))
    stand = written(stand.withColumn("rep", F.monotonically_increasing_id()), "minhash-copies")
    nodes = stand.select("rep", "first", "copy")

    members = stand.select(F.explode("bands").alias("bucket"), "rep")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(members.join(shared, "bucket"), "minhash-members")
    company = members.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("company"))
    ranked = members.join(company, "rep")
    best = F.max(F.struct("company", (-F.col("rep")).alias("low")))
    leader = written(ranked.groupBy("bucket").agg(best.alias("best")), "minhash-leaders")
    stars = members.join(leader, "bucket").select((-F.col("best.low")).alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()
    stars = written(stars, "minhash-stars")
    held = _sets(texts, stars.select(F.explode(F.array("a", "b")).alias("rep")), nodes, shingle)
    links = written(_verified(stars, held, similarity), "minhash-links")

    # What the leaders left apart. A member's home is the leader of all its buckets with the most company; the members of a home, near copies of
    # one text mostly, are compared by blocks.
    home = members.join(leader, "bucket").groupBy("rep").agg((-F.max("best")["low"]).alias("home"))
    home = written(home, "minhash-homes")

    def placed(links: DataFrame) -> DataFrame:
        group = components(links).withColumnRenamed("node", "rep")
        return home.join(group, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    links = links.unionByName(written(_within_homes(placed(links), held, similarity), "minhash-home-links"))
    # Members of different homes and components that share a bucket are compared pair by pair.
    grouped = written(members.select("bucket", "rep").join(placed(links), "rep"), "minhash-grouped")
    ends = [F.min("component").alias("lc"), F.max("component").alias("hc"), F.min("home").alias("lh"), F.max("home").alias("hh")]
    apart = grouped.join(grouped.groupBy("bucket").agg(*ends).where("lc < hc and lh < hh").select("bucket"), "bucket", "left_semi")
    other = apart.select("bucket", F.col("rep").alias("b"), F.col("component").alias("cb"), F.col("home").alias("hb"))
    across = apart.select("bucket", F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("home").alias("ha")).join(other, "bucket")
    across = across.where("ca < cb and ha <> hb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.unionByName(written(_verified(across, held, similarity), "minhash-more"))

    own = nodes.join(components(links).withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    roots = own.groupBy("component").agg(F.min(F.struct("first", "copy")).alias("root"))
    return signed.select("doc_id", "copy"), written(own.join(roots, "component").select("copy", "first", "root"), "minhash-classes")


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its near-duplicate class), kept (whether it is that one).

    Words are lower-cased and split at white space; the weight of a shingle is its number of occurrences.

    Defined results: equal texts are one class. Null texts and texts without words are in no class but their own. Texts of fewer words than a
    shingle are one shingle. Rows with equal ids count as one document with several texts: they get one row each, of the class of any. Rows
    with null id are returned with null class and kept. An empty table gives no rows. Other columns are not read.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    every, classes = _classes(texts, shingle, similarity, bands, rows)
    alike = every.join(classes.select("copy", F.col("root.first").alias("root")), "copy").where("doc_id is not null")
    found = written(alike.groupBy("doc_id").agg(F.min("root").alias("class_id"), F.max("root").alias("other")), "minhash-found")
    several = found.where("class_id <> other or class_id > doc_id")
    if several.limit(1).count():  # an id whose texts are of several classes joins them
        joined = components(alike.select(F.col("doc_id").alias("a"), F.col("root").alias("b")).distinct())
        found = joined.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))
    result = every.select("doc_id").join(found.select("doc_id", "class_id"), "doc_id", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return result.select("doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def one_of_each_class(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns, that stand for their near-duplicate class.

    Defined results: rows are told apart by id and text. Of each class the row with the smallest id stays, and of several such rows with different texts the one
    with the smallest hash. A row that resembles no other stays, whatever else has its id; null texts and texts without words resemble nothing. Of rows with equal id and
    equal text one stays, the first by its columns written as JSON. Rows with null id stay. An empty table gives no rows; texts are read whole.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    every, classes = _classes(texts, SHINGLE, SIMILARITY, BANDS, ROWS)
    pairs = written(every.where("doc_id is not null").groupBy("doc_id", "copy").agg(F.count(F.lit(1)).alias("n")), "minhash-pairs")
    judged = pairs.join(classes.select("copy", "root"), "copy", "left")
    stays = F.coalesce((F.col("root.first") == F.col("doc_id")) & (F.col("root.copy") == F.col("copy")), F.lit(True))
    judged = written(judged.select("doc_id", "copy", "n", stays.alias("stays")), "minhash-judged")
    columns = [f"own_{i}" for i in range(len(documents.columns))]  # own names cannot clash with what is joined
    own_id, own_text = (columns[documents.columns.index(c)] for c in (id_column, text_column))
    own = documents.toDF(*columns).withColumns({"own_copy": F.unhex(F.md5(whole_text(own_text).cast("binary")))})

    def where_listed(listed: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        listed = listed.select("doc_id", "copy")
        few = listed.count() <= IDS_SENT
        match = (F.col(own_id).cast("long") == F.col("doc_id")) & (F.col("own_copy") == F.col("copy"))
        return rows.join(F.broadcast(listed) if few else listed, match, how)

    kept = where_listed(judged.where(~F.col("stays")), "left_anti", own)
    again = judged.where("stays and n > 1")
    if again.limit(1).count():
        whole = F.struct(*columns)
        once = where_listed(again, "left_semi", kept).groupBy(own_id, "own_copy").agg(F.min_by(whole, F.to_json(whole)).alias("row"))
        kept = where_listed(again, "left_anti", kept).select(*columns).unionByName(once.select("row.*"))
    return kept.select(*columns).toDF(*documents.columns)
