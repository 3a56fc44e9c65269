"""Operator 2, WARC fixity audit by Merkle trees.

Records are hashed and laid out in archive files at running offsets, each replica by its own lengths. A file
gets a tree: a node covers an ordered range of offsets and hashes the lengths and hashes of its children in
order. A node ends behind a child whose hash ends in 0, so about every sixteenth, and the file's root covers
what is left; so a lost or added record moves all offsets behind it but changes the nodes above itself only.
Two replicas are compared root by root; of files that differ only the nodes that the other replica's
mismatching branches lack are entered, level by level, down to the records. Every level is one grouped
aggregation within files, and every step of the descent two anti joins with the branches that still mismatch.

Records that one replica lacks and the other has under the same identity are ``altered``; others are
``missing`` from the replica or ``extra`` in it.

Defined results: null url or html counts as empty; null and repeated page_ids are records of their own, null ones
first and repeated ones in the order of their addresses and digests, whatever the size of the ids; equal
records of one file are matched as often as both replicas hold them; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, table
from .shards import numbered

#: Records of a file, levels of nodes between records and root, and one record in DAMAGE with each kind of damage.
RECORDS_PER_FILE, LEVELS, DAMAGE = 1024, 2, 200


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """Bytes of a WARC/1.0 response record (as a string): header lines, payload, two line ends."""
    page_id = F.coalesce(page_id.cast("string"), F.lit(""))
    url, html = (F.coalesce(c.cast("string"), F.lit("")) for c in (url, html))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), page_id, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.sha1(html.cast("binary")),
        F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"),
    )


def files_of(records: DataFrame, per_file: int = RECORDS_PER_FILE, order: tuple[str, ...] = ("key",)) -> DataFrame:
    """Adds ``file`` and ``record_no`` to the rows: the original archive in the order of the columns named."""
    placed = numbered(records.withColumn("_one", F.lit(1)), "_one", order[-1], list(order[:-1]))
    return placed.withColumns({"file": F.floor(F.col("place") / per_file).cast("long"), "record_no": (F.col("place") % per_file).cast("long")}).drop("_one", "place", "offset")


def laid_out(records: DataFrame) -> DataFrame:
    """Adds ``offset``: the bytes before a record in its file, by file and record_no."""
    before = Window.partitionBy("file").orderBy("record_no").rowsBetween(Window.unboundedPreceding, -1)  # a file holds a bounded number
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def merkle_levels(records: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """(file, start, length, hash, up) from the records up to one root per file; ``up`` is the node above."""
    out = []
    nodes = records.select("file", F.col("offset").alias("start"), "length", F.col("digest").alias("hash"), "record_no")
    for level in range(levels + 1):
        order = ["start", "record_no"]
        if level < levels:
            ends = F.when(F.col("hash").endswith("0"), 1).otherwise(0)
            up = F.coalesce(F.sum(ends).over(Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        else:
            up = F.lit(0)
        nodes = durable(nodes.withColumn("up", up.cast("long")))
        out.append(nodes)
        child = F.struct(*order, F.concat_ws(":", F.col("length").cast("string"), F.col("hash")).alias("c"))
        nodes = (
            nodes.groupBy("file", "up").agg(F.min("start").alias("start"), F.sum("length").alias("length"), F.sort_array(F.collect_list(child)).alias("children"))
            .select("file", "start", "length", F.sha2(F.array_join(F.col("children.c"), ",").cast("binary"), 256).alias("hash"), F.col("up").alias("record_no"))
        )
    return [*out, durable(nodes)]


def mismatches(left: list[DataFrame], right: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(file, record_no) of the records that one replica has and the other lacks, found by entering mismatching
    branches only."""
    sides = [x[-1] for x in (left, right)]
    for level in range(len(left) - 1, -1, -1):
        nth = F.row_number().over(Window.partitionBy("file", "hash", "length").orderBy("start", "record_no"))
        counted = [x.withColumn("nth", nth) for x in sides]
        names = [x.select("file", "hash", "length", "nth") for x in counted]
        apart = [durable(a.join(b, ["file", "hash", "length", "nth"], "left_anti").select("file", "record_no")) for a, b in zip(counted, reversed(names), strict=True)]
        if level:
            sides = [x[level - 1].join(b.withColumnRenamed("record_no", "up"), ["file", "up"], "left_semi") for x, b in zip((left, right), apart, strict=True)]
    return apart[0], apart[1]


def audit(original: DataFrame, replica: DataFrame, levels: int = LEVELS) -> DataFrame:
    """All records of the original and the extra ones of the replica, with status and both roots of their file.

    Both have file, record_no, identity, length and digest; offsets are laid out here, each replica by itself.
    """
    original, replica = (durable(laid_out(x)) for x in (original, replica))
    left, right = merkle_levels(original, levels), merkle_levels(replica, levels)
    lost, found = mismatches(left, right)
    nth = F.row_number().over(Window.partitionBy("file", "identity").orderBy("record_no")).alias("nth")
    lost = original.join(lost, ["file", "record_no"], "left_semi").select("file", "record_no", "identity", nth)
    added = ["page_id", "offset", "length", "digest"]
    found = replica.join(found, ["file", "record_no"], "left_semi").select("file", "identity", nth, *[F.col(c).alias(f"replica_{c}") for c in added])
    pairs = durable(lost.join(found, ["file", "identity", "nth"], "full").withColumn("apart", F.lit(True)))
    known = pairs.filter("record_no IS NOT NULL").drop("identity", "nth", "replica_page_id")
    rows = original.join(known, ["file", "record_no"], "left").withColumn(
        "status", F.when(F.col("apart").isNull(), "intact").when(F.col("replica_digest").isNull(), "missing").otherwise("altered"))
    columns = ["page_id", "file", "record_no", "offset", "length", "digest", "replica_offset", "replica_length", "replica_digest", "status"]
    extra = pairs.filter("record_no IS NULL").withColumnRenamed("replica_page_id", "page_id").withColumns({"status": F.lit("extra"), **{c: F.lit(None).cast("long") for c in ("offset", "length")}, "digest": F.lit(None).cast("string")})
    roots = left[-1].select("file", F.col("hash").alias("root")).join(right[-1].select("file", F.col("hash").alias("replica_root")), "file", "full")
    return rows.select(*columns).unionByName(extra.select(*columns)).join(roots, "file", "left").select(*columns, "root", "replica_root")


def damaged(damage: Column) -> Column:
    """What a replica holds of a row with record and identity, as an array of both: where damage is 0 the payload's
    end is overwritten, where 1 it is cut, where 2 the record is lost, where 3 another record follows it."""
    held = lambda record, identity=F.col("identity"): F.struct(record.alias("record"), identity.alias("identity"))
    end = F.lit("\r\n\r\n")
    body = F.expr("substring(record, 1, length(record) - 5)")
    changed = F.when(damage == 0, F.concat(body, F.lit("\x00"), end)).when(damage == 1, F.concat(body, end)).otherwise(F.col("record"))
    extra = held(F.concat(F.col("record"), F.lit("again")), F.concat(F.col("identity"), F.lit(" again")))
    return F.when(damage == 2, F.array().cast("array<struct<record:string,identity:string>>")).when(damage == 3, F.array(held(F.col("record")), extra)).otherwise(F.array(held(changed)))


def hashed(copies: Column) -> Column:
    """Length and digest in place of each record."""
    return F.transform(copies, lambda c: F.struct(c["identity"].alias("identity"), F.octet_length(c["record"]).cast("long").alias("length"), F.sha2(c["record"].cast("binary"), 256).alias("digest")))


def replica_of(archive: DataFrame, copies: str) -> DataFrame:
    """The replica's records, in the original order of what they stem from."""
    out = archive.select("page_id", "file", "record_no", F.posexplode(copies).alias("copy", "c"))
    return out.select("page_id", "file", (F.col("record_no") * 2 + F.col("copy")).alias("record_no"), "c.*")


def op2_merkle_fixity(spark, sf_dir: str) -> DataFrame:
    """Audit of an archive of all pages against a replica with known damage.

    The replica is made here, as no damaged copy is among the tables: by a hash of the page one record in DAMAGE
    is overwritten, one cut, one lost and one followed by another record, and it is laid out after that. Records
    are hashed where they are read; only lengths and digests travel.
    """
    pages = table(spark, sf_dir, "pages")
    identity = F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    rows = pages.select("page_id", identity.alias("identity"), warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    damage = F.pmod(F.conv(F.substring(F.md5(F.col("identity").cast("binary")), 1, 6), 16, 10).cast("long"), F.lit(DAMAGE))
    own = F.array(F.struct("record", "identity"))
    digests = durable(rows.select("page_id", F.get(hashed(own), F.lit(0)).alias("own"), hashed(damaged(damage)).alias("copies")).select("page_id", "own.*", "copies"))
    archive = durable(files_of(digests, order=("page_id", "identity", "digest")))
    return audit(archive.drop("copies"), replica_of(archive, "copies"))


_LEVEL = """{up}0 AS (SELECT *, coalesce(sum(CASE WHEN hash[-1] = '0' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY start, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS up FROM {down}),
{up} AS (SELECT file, min(start) AS start, sum(length)::BIGINT AS length, sha256(string_agg(length || ':' || hash, ',' ORDER BY start, no)) AS hash, up AS no FROM {up}0 GROUP BY file, up)"""
_ROOT = "{root} AS (SELECT file, sha256(string_agg(length || ':' || hash, ',' ORDER BY start, no)) AS hash FROM {down} GROUP BY file)"
OP2_SQL = f"""
WITH r AS (
  SELECT page_id, page_id || ' ' || coalesce(url, '') AS identity, row_number() OVER (ORDER BY page_id) - 1 AS place,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Payload-Digest: sha1:' || sha1(coalesce(html, ''))
    || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
a AS (SELECT *, place // {RECORDS_PER_FILE} AS file, place % {RECORDS_PER_FILE} AS no, ('0x' || md5(identity)[1:6])::BIGINT % {DAMAGE} AS damage FROM r),
b AS (
  SELECT page_id, file, no * 2 AS no, damage, CASE WHEN damage = 0 THEN record[1:-6] || chr(0) || record[-4:] WHEN damage = 1 THEN record[1:-6] || record[-4:] ELSE record END AS record FROM a WHERE damage <> 2
  UNION ALL SELECT page_id, file, no * 2 + 1, -1, record || 'again' FROM a WHERE damage = 3),
la AS (SELECT *, octet_length(encode(record)) AS length, sha256(record) AS hash, coalesce(sum(octet_length(encode(record))) OVER (PARTITION BY file ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM a),
lb AS (SELECT *, octet_length(encode(record)) AS length, sha256(record) AS hash, coalesce(sum(octet_length(encode(record))) OVER (PARTITION BY file ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM b),
{_LEVEL.format(up='la1', down='la')}, {_LEVEL.format(up='la2', down='la1')}, {_ROOT.format(root='ra', down='la2')},
{_LEVEL.format(up='lb1', down='lb')}, {_LEVEL.format(up='lb2', down='lb1')}, {_ROOT.format(root='rb', down='lb2')},
t AS (
  SELECT la.page_id, la.file, la.no AS record_no, la.start AS "offset", la.length, la.hash AS digest,
    CASE WHEN la.damage IN (0, 1) THEN lb.start END AS replica_offset, CASE WHEN la.damage IN (0, 1) THEN lb.length END AS replica_length, CASE WHEN la.damage IN (0, 1) THEN lb.hash END AS replica_digest,
    CASE WHEN la.damage IN (0, 1) THEN 'altered' WHEN la.damage = 2 THEN 'missing' ELSE 'intact' END AS status
  FROM la LEFT JOIN lb ON lb.file = la.file AND lb.no = la.no * 2
  UNION ALL SELECT page_id, file, NULL, NULL, NULL, NULL, start, length, hash, 'extra' FROM lb WHERE damage = -1)
SELECT t.*, ra.hash AS root, rb.hash AS replica_root FROM t LEFT JOIN ra USING (file) LEFT JOIN rb USING (file)
"""
