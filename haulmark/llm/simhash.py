"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits that differ in at most `distance` bits are linked, and links joined into
components. Two such fingerprints differ in at most half as many bits in one of their two
32-bit halves, so each half is searched on its own with the half threshold.

Anchors of a half: the words of the perfect Hamming code on 31 bits with the last bit free, a
covering code of radius 1. A fingerprint is at home at its nearest anchor and is replicated to every
anchor within radius plus half threshold; a partner within the half threshold is then among
them. Each anchor compares its homes with its replicas.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import written

#: Parity masks of the Hamming code: mask k holds the places (from 1) whose bit k is set.
PARITY = [sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)]

#: Hashes whose bits are counted at once.
BLOCK = 65536


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint of one text; its bits are set where over half of the shingles' hashes set them."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = (digest(b" ".join(x), 42) for x in zip(*(words[i:] for i in range(n)), strict=False))
    total = len(words) - n + 1
    counts = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        block = np.fromiter(hashes, "<u8", min(BLOCK, total - start))
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of whole texts as a signed long: A-Z lower-cased, word shingles, XXH64 with seed 42."""

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(x, shingle) for x in texts], dtype="int64")

    return simhash(text)


def hexadecimal(fp: Column) -> Column:
    """A fingerprint as 16 lower-case digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _anchors(word: Column, half: int, threshold: int) -> Column:
    """Every anchor within 1 + `threshold` bits of a 32-bit word; without a threshold its nearest, the home."""
    low = word.bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))
    parity = [F.shiftleft(F.bit_count(low.bitwiseAND(F.lit(m).cast("long"))).bitwiseAND(F.lit(1)), k) for k, m in enumerate(PARITY)]
    syndrome = parity[0] + parity[1] + parity[2] + parity[3] + parity[4]
    one = F.lit(1).cast("long")

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", one, (place - 1).cast("int"))

    nearest = F.when(syndrome == 0, word).otherwise(word.bitwiseXOR(bit(F.greatest(syndrome, F.lit(1)))))
    offset = F.lit(half << 32).cast("long")

    found = F.array(nearest + offset)
    if threshold:
        other_last_bit = nearest.bitwiseXOR(F.lit(1 << 31).cast("long")) + offset
        # a word off the code has the words at two bits from it: the pairs of places whose sum is its syndrome
        firsts = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (i < i.bitwiseXOR(syndrome)) & (i != syndrome))
        second = F.transform(
            firsts, lambda i: word.bitwiseXOR(bit(i)).bitwiseXOR(bit(i.bitwiseXOR(syndrome))) + offset
        )
        found = F.concat(found, F.array(other_last_bit), second)
    return found


def near_pairs(nodes: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) between the rows (node, fp) of distinct fingerprints at most `distance` bits apart.

    Each fingerprint goes to 1 home and at most 16 more anchors per half, whatever the table's
    size; an anchor is one of 2^27 per half. The join compares on bits and only links leave it.
    Both sides come straight from a shuffle, so Spark splits an anchor that holds very many. Neither is
    broadcast: Spark's estimate of them leaves out that each fingerprint becomes up to 34 rows.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the code on halves serves distances from 0 to 3")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    high = F.shiftrightunsigned("fp", 32)

    def spread(threshold: int, node: str, fp: str) -> DataFrame:
        anchors = F.concat(_anchors(low, 0, threshold), _anchors(high, 1, threshold))
        return nodes.select(F.col("node").alias(node), F.col("fp").alias(fp), F.explode(anchors).alias("anchor"))

    homes, guests = spread(0, "a", "fp_a"), spread(distance // 2, "b", "fp_b")
    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= distance
    return homes.join(guests.hint("merge"), "anchor").filter((F.col("fp_a") < F.col("fp_b")) & near).select("a", "b")


#: Parts into which the links of one node are split where stars meet.
SPLIT = 8


def _toward_minimum(links: DataFrame, larger_only: bool) -> DataFrame:
    """One star step on links (u, v): v, and u itself, are linked to the smallest neighbour of u."""
    if not larger_only:
        links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    parts = lowest.withColumn("part", F.explode(F.array(*map(F.lit, range(SPLIT)))))
    dealt = links.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SPLIT)).cast("int"))
    met = dealt.join(parts.hint("merge"), ["u", "part"])  # as Spark's estimate of them leaves out that there are `SPLIT` of each
    if larger_only:
        moved = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x")).select(
            "x.u", F.col("x.m").alias("v")
        )
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b): root is the smallest node reachable, itself included.

    Alternates large-star and small-star steps until the links are stars around roots. The
    links are written after each round; the driver sees their number and checksum only.
    """
    links = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        links = written(_toward_minimum(_toward_minimum(links, True), False), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def named_components(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(fp, root, component_id) of each fingerprint in `prints` (_key, fp).

    Fingerprints are linked whatever their keys; root is the smallest one reachable, and component_id
    the smallest key of the component, null if it has none.
    """
    nodes = written(prints.groupBy("fp").agg(F.min("_key").alias("least")), "nodes")
    roots = components(near_pairs(nodes.select(F.col("fp").alias("node"), "fp"), distance))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    rooted = written(rooted, "rooted")
    firsts = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "firsts")
    return written(rooted.join(firsts, "root").select("fp", "root", "component_id"), "components")


def rooted_documents(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: _key, _text (hash of the text), fp, root and component_id of `named_components`."""
    prints = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_text"), fingerprint(F.col(text), shingle).alias("fp"))
    prints = written(prints, "fingerprints")
    return prints.join(named_components(prints, distance), "fp").select("_key", "_text", "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: key, fp (signed long) and component_id, the smallest key reachable.

    Equal fingerprints are one node of the graph, named by the fingerprint, so copies are never
    paired. Null and empty texts, and texts of white space, have fingerprint zero and are linked
    like others; shorter texts than a shingle count as one shingle. Repeated rows stay repeated.
    A row with a null key links like others and gets the component of its fingerprint, null if no row of that has a key.
    Other columns are ignored; an empty table gives no rows.
    """
    return rooted_documents(docs, shingle, distance, key, text).select(F.col("_key").alias(key), "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each component: the smallest key (null last), then the smallest hash of the text.

    Of rows equal in both the first by their other columns stays. Rows that repeat a key in different
    components are different documents and all stay. Null and empty texts are one component. Columns
    stay as they are, whatever their names; texts of any length are read whole; an empty table gives no rows.
    """
    found = rooted_documents(docs, shingle, distance, key, text)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("_key").isNull().alias("n"), "_key", "_text")).alias("first"))
    first = first.select(F.col("first._key").alias("_key"), F.col("first._text").alias("_text"))
    others = F.to_json(F.struct(*(docs[c] for c in docs.columns if c not in (key, text)), F.lit(0).alias("_")))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[key].alias("k"), F.xxhash64(docs[text]).alias("t"), others.alias("others"))
    kept = rows.join(first, F.col("k").eqNullSafe(F.col("_key")) & (F.col("t") == F.col("_text")))
    kept = kept.groupBy("_key", "_text").agg(F.min_by("row", "others").alias("row"))
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
