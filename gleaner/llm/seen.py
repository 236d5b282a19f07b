"""Deduplicating new batches against all history.

A row's page is known by its id (letter case aside) and by its address; the relation is transitive. Addresses are brought
to one spelling, turned into vectors of their words and kept in persisted cells (gleaner.llm.cells). The batches (days) probe
the cells one after the other, in two rounds: an address first its own cell, of it only the ring at the same distance from
the centroid; what is not found there then the cells that the bounds do not exclude. What lies there is compared exactly, on
the vector and on the page, and what is not held is appended. Which page a row has is told by the entry that its probe found
or opened, and by nothing else. Ids, and the labels of what is linked, are kept beside the cells and looked up for the
batch's own ids and pages.

Defined results: a row without a readable first_seen is never a case but links others; a row with neither id nor http(s)
address is none; repeated rows are cases from the second on; an empty pool or ledger gives what is left. A row of an earlier
batch that only a later batch links to an earlier page is found where both are taken together."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.dates import day_of
from gleaner.llm import cells
from gleaner.session import shared_dir, spread, written

#: Parameters that follow a reader or a share, carry a session or ask for another rendering (fixed values).
PASSING = frozenset(
    "gclid gclsrc dclid gbraid wbraid fbclid msclkid yclid twclid ttclid li_fat_id igsh igshid mc_cid mc_eid mkt_tok _hsenc _hsmi __hssc __hstc hsctatracking "
    "_ga _gl s_cid s_kwcid ncid ocid cid cmp cmpid cmpn campaign campaignid trk trkinfo trackingid wt_mc wt.mc_id vero_id vero_conv oly_enc_id oly_anon_id rb_clickid "
    "spm scm share shared shareid share_id sharesource via ref ref_src ref_url referrer referer refsrc src source from feature origin smid smtyp sr_share xtor at_medium at_campaign "
    "phpsessid jsessionid aspsessionid sessionid session_id session sid cfid cftoken zenid osid token_id "
    "amp outputtype print printable printview view_as mobile m nocache _ timestamp".split()
)
PASSING_STARTS = ("utm_", "utm-", "pk_", "piwik_", "mtm_", "matomo_", "hsa_", "ga_", "fb_", "stm_", "itm_", "at_custom", "aspsessionid")
SCHEME = re.compile(r"^https?:/{2,}([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", re.I | re.S)
FRONT = re.compile(r"^(?:(?:www\d?|m|mobile|amp)\.)+(?=[^.]+\.)")
INDEX = re.compile(r"/(?:(?:index|default)\.(?:html?|php|aspx?|jsp))$", re.I)
RENDER = re.compile(r"/(?:amp|print|mobile)$|\.amp$", re.I)


def page_address(url: str | None) -> str | None:
    """One spelling for all addresses of a page; None for what is no http(s) address.

    Scheme, user, default port, final dot, www., m. and amp. of the host, doubled and final slashes, index files, amp and
    print renderings, the fragment, the order of parameters and the parameters of PASSING make no other page; letter
    case of the path and every other parameter do."""
    if not isinstance(url, str):
        return None
    m = SCHEME.match(re.sub(r"[\t\r\n]", "", url.strip()))
    if not m:
        return None
    host = m.group(1).rpartition("@")[2].lower()
    host = re.sub(r":(?:80|443)?$", "", host).rstrip(".")
    if not host:
        return None
    host = FRONT.sub("", host)
    path = m.group(2).replace("\\", "/").strip()
    if "%" in path:
        path = _decoded(path)
    path = re.sub(r";(?:jsessionid|phpsessid|sid)=[^/]*", "", path, flags=re.I)
    path = re.sub(r"/{2,}", "/", path).rstrip("/")
    for _ in range(2):
        path = RENDER.sub("", INDEX.sub("", path)).rstrip("/")
    query = []
    if m.group(3):
        for part in re.split(r"[&;]", m.group(3)):
            name, _, value = part.partition("=")
            low = name.strip().lower()
            if not low or low in PASSING or low.startswith(PASSING_STARTS):
                continue
            query.append(f"{_decoded(name.strip())}={_decoded(value.strip())}")
    return f"{host}{path}" + ("?" + "&".join(sorted(set(query))) if query else "")


def _decoded(text: str) -> str:
    """Percent escapes of letters, digits and marks that need none; others in upper case."""
    def one(m: re.Match) -> str:
        c = unquote(m.group(0))
        return c if re.fullmatch(r"[A-Za-z0-9._~!'()*,:@+-]", c) or (len(c) == 1 and ord(c) > 127) else m.group(0).upper()

    return re.sub(r"(?:%[89A-Fa-f][0-9A-Fa-f])+|%[0-9A-Fa-f]{2}", one, text)


WORDS = re.compile(r"[^\W_]+")

PLACED = "origin string, row_no bigint, day int, id string, key string, vec binary, at array<struct<cell:int,ring:int,far:double,own:boolean>>"


def _placed(centers: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, np.ndarray] = {}
        for b in batches:
            page = [page_address(u) for u in b["url"]]
            have = [i for i, p in enumerate(page) if p is not None]
            vec: list[bytes | None] = [None] * len(page)
            at: list[list[dict]] = [[] for _ in page]
            if have:
                v = np.stack([cells.token_vector(WORDS.findall(page[i]), cache) for i in have])
                for i, x in zip(have, v):
                    vec[i] = x.tobytes()
                for r, c, g, far, own in zip(*(x.tolist() for x in cells.visits(v, centers))):
                    at[have[r]].append({"cell": c, "ring": g, "far": far, "own": own})
            yield pd.DataFrame({"origin": b["origin"], "row_no": b["row_no"], "day": b["day"], "id": b["id"], "key": page, "vec": vec, "at": at})

    return run


def _rows(pool: DataFrame, ledger: DataFrame | None) -> DataFrame:
    ident = F.nullif(F.lower(F.trim("id")), F.lit(""))
    number = lambda day: F.unix_date(day).alias("day")
    rows = pool.select(F.lit("pool").alias("origin"), F.col("row_no").cast("bigint").alias("row_no"), number(day_of(F.col("first_seen"))), ident.alias("id"), "url")
    if ledger is not None:
        day = day_of(F.coalesce(F.nullif(F.trim("published"), F.lit("")), F.col("date")))
        rows = rows.unionByName(ledger.select(F.lit("ledger").alias("origin"), F.lit(None).cast("bigint").alias("row_no"), number(day), ident.alias("id"), "url"))
    return rows


def fit_centers(pool: DataFrame, count: int = 256, sample: int = 8192) -> np.ndarray:
    """Centroids of the address vectors of about `sample` rows, at most twice as many."""
    cache: dict[str, np.ndarray] = {}
    pages = {p for r in cells.sampled(pool.where("url is not null").select("url"), sample) if (p := page_address(r[0]))}
    return cells.centroids(np.array([cells.token_vector(WORDS.findall(p), cache) for p in sorted(pages)], np.float32), count)


def placed(pool: DataFrame, ledger: DataFrame | None, centers: np.ndarray) -> DataFrame:
    """All rows: a (hash of the id), q (the query: hash of page and day, or of the id where there is no page), b (hash of the page),
    vec and the rings of cells that a probe for the page visits. Rows with neither are left out."""
    rows = spread(_rows(pool, ledger)).mapInPandas(_placed(centers), PLACED)
    ident = F.when(F.col("id").isNotNull(), F.unhex(F.md5(F.concat(F.lit("i"), "id"))))
    page = F.when(F.col("key").isNotNull(), F.unhex(F.md5(F.concat(F.lit("u"), "key"))))
    query = F.when(F.col("key").isNotNull(), F.unhex(F.md5(F.concat(F.lit("q"), F.coalesce(F.col("day").cast("string"), F.lit("")), F.lit(" "), "key"))))
    return rows.select("origin", "row_no", "day", ident.alias("a"), F.coalesce(query, ident).alias("q"), page.alias("b"), "vec", "at").where("q is not null")


ENTRY = "cell int, ring int, far double, b binary, vec binary, node binary"
COLUMNS = [x.split()[0] for x in ENTRY.split(", ")]
#: What a page is known by: its first pool row and ledger day, and the rows that have it.
FACTS = "first_day int, first_row bigint, listed int, n bigint"
FACT_COLUMNS = [x.split()[0] for x in FACTS.split(", ")]
PROBED = f"{ENTRY}, q binary, {FACTS}, opened boolean"
#: The order of batches: what is held, rows without a day, days.
HELD, UNDATED = -(2**31), -(2**31) + 1


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is held of whole rings of cells, then the queries batch by batch (`turn`): each finds the entry of its page or
    opens one, which the next batches find. Gives the queries with the node of their entry; opened ones have the entry's
    columns, which are null for others."""
    shard, waiting = cells.Shard(), []

    def arrays(t: pa.Table) -> tuple:
        join = lambda c: b"".join(t.column(c).to_pylist())
        at = cells.Shard.place(t.column("cell").to_numpy(), t.column("far").to_numpy())
        return at, np.frombuffer(join("vec"), np.float32).reshape(t.num_rows, -1), np.frombuffer(join("b"), np.uint64).reshape(-1, 2)

    def taken() -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        t = pa.Table.from_batches(waiting)
        waiting.clear()
        at, vec, page = arrays(t)
        q = np.array(t.column("node").to_pylist(), object)
        x = shard.probe(at, vec, page)
        new, node = x < 0, q.copy()
        node[~new] = shard.node[x[~new]]
        shard.add(at[new], vec[new], page[new], q[new])
        own = pa.array(new)
        none = lambda c: pa.compute.if_else(own, t.column(c).combine_chunks(), pa.scalar(None, t.schema.field(c).type))
        columns = {c: none(c) for c in ("cell", "ring", "far", "b", "vec")} | {"node": pa.array(node, pa.binary()), "q": t.column("node")} | {c: t.column(c) for c in FACT_COLUMNS} | {"opened": own}
        yield from pa.table(columns).to_batches()

    turn = None
    for batch in batches:
        turns = batch.column("turn").to_numpy()
        cuts = [0, *(np.flatnonzero(turns[1:] != turns[:-1]) + 1).tolist(), len(turns)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if turns[start] == HELD:
                t = pa.Table.from_batches([part])
                shard.add(*arrays(t), np.array(t.column("node").to_pylist(), object))
                continue
            if turns[start] != turn:
                yield from taken()
                turn = turns[start]
            waiting.append(part)
    yield from taken()


def probed(queries: DataFrame, held: DataFrame | None, n: int) -> DataFrame:
    """The queries (COLUMNS with q as node, turn, FACTS) with the entries they found or opened; tasks hold whole rings of cells, about
    200,000 entries each."""
    if held is not None:
        nothing = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in FACTS.split(", ")]
        queries = queries.unionByName(held.select(*COLUMNS, F.lit(HELD).alias("turn"), *nothing))
    parts = max(queries.sparkSession.sparkContext.defaultParallelism, n // 200_000 + 1)
    return queries.repartition(parts, "cell", "ring").sortWithinPartitions("turn", "cell", "far").mapInArrow(_probed, PROBED)


def components(edges: DataFrame) -> DataFrame:
    """(b, label) of the two-sided graph (a, b): the least b reachable. Labels pass from b to a and back until none changes;
    from the third round on a label also takes its own label's, so that long chains need few rounds. Every round is a
    written table, so neither lineage nor driver grows."""
    edges = written(edges.distinct())
    labels = written(edges.select("b").distinct().withColumn("label", F.col("b")))
    rounds = 0
    while True:
        rounds += 1
        at_a = edges.join(labels, "b").groupBy("a").agg(F.min("label").alias("label"), F.max("label").alias("most"))
        # where all b of an a agree already, the a has nothing to pass on
        passing = written(at_a.where(F.col("label") < F.col("most")).select("a", "label"))
        if passing.isEmpty():
            return labels
        better = edges.join(passing, "a").groupBy("b").agg(F.min("label").alias("less"))
        labels = written(labels.join(better, "b", "left").select("b", F.least("label", "less").alias("label")))
        if rounds > 2:
            own = labels.select(F.col("b").alias("label"), F.col("label").alias("far"))
            labels = written(labels.join(own, "label").select("b", F.least("label", "far").alias("label")))


class History:
    """Persisted state in the folder `path`, to which batches are appended and in which they are looked up:

    cells   an entry of a page: cell, ring, distance to the centroid, vector in full, the page's hash, the entry's node
    labels  (node, label) of the ids and entries of a batch that no batch before had; a label stands for all that is linked
    firsts  (label, first pool row, ledger day) as each batch added to them
    merges  (old, label): labels that a later batch linked

    A batch reads the rings of cells that its addresses visit, the labels of its own ids and entries and what is kept under
    these, and the merges; all tables are only appended to. A table of many days may be taken at once: within the rings of
    a task its days are taken one by one, in order."""

    TABLES = {"cells": ENTRY, "labels": "node binary, label binary", "firsts": "label binary, first_day int, first_row bigint, listed int", "merges": "a binary, b binary"}

    def __init__(self, path: str, centers: np.ndarray) -> None:
        self.path, self.centers = path, centers
        #: Of the last batch: entries read and kept, rings visited and held.
        self.figures: dict[str, int] = {}

    def _filled(self, spark: SparkSession) -> bool:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/merges")
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def held(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.schema(self.TABLES[table]).parquet(f"{self.path}/{table}")

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{table}")

    def _probe(self, filled: bool, batch: DataFrame, queries: DataFrame, n: int) -> tuple[DataFrame, DataFrame | None]:
        """The queries with the entries that they found in their own cells or opened there, and (node, other) of opened ones whose
        page another cell has: round two, in the cells that the bounds leave, of what round one did not find."""
        spark = batch.sparkSession
        ring = ["cell", "ring"]
        old = None
        if filled:
            units = F.broadcast(queries.select(ring).distinct())  # at most the rings of all cells, whatever the batch
            kept = self.held(spark, "cells")
            old = kept.join(units, ring, "left_semi")
            count = [F.count("*").alias("n"), F.countDistinct(*ring).alias("rings")]
            read, every = old.agg(*count).head(), kept.agg(*count).head()
            self.figures = {"entries_read": read.n, "entries_kept": every.n, "rings_visited": read.rings, "rings_kept": every.rings}
            n += read.n
        pages = written(probed(queries, old, n))
        others = batch.where(F.size("at") > 1).select("q", "b", "vec", F.inline("at")).where("not own").distinct()
        if others.isEmpty():
            return pages, None
        opened = pages.where("opened")
        others = written(others.join(opened.select("q"), "q", "left_semi"))
        units = F.broadcast(others.select(ring).distinct())
        there = opened.select(COLUMNS) if not filled else opened.select(COLUMNS).unionByName(self.held(spark, "cells"))
        there = there.join(units, ring, "left_semi")
        nothing = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in FACTS.split(", ")]
        again = others.select("cell", "ring", "far", "b", "vec", F.col("q").alias("node"), F.lit(UNDATED).alias("turn"), *nothing)
        return pages, written(probed(again, there, n).where("not opened").select(F.col("q").alias("node"), F.col("node").alias("other")))

    def take(self, pool: DataFrame, ledger: DataFrame | None = None, append: bool = True) -> DataFrame:
        """row_no and day of the pool rows whose page the history, the ledger or an earlier row of the batch had; then appends the
        batch."""
        spark = pool.sparkSession
        filled = self._filled(spark)
        batch = written(placed(pool, ledger, self.centers))
        mine = F.when((F.col("origin") == "pool") & F.col("day").isNotNull(), F.col("row_no"))
        facts = [F.min(F.when(mine.isNotNull(), F.col("day"))).alias("first_day"), F.min(mine).alias("first_row"), F.min(F.when(F.col("origin") == "ledger", F.col("day"))).alias("listed"), F.count("*").alias("n")]
        # one query of a page a day: rows of one page do not meet in a task
        own = F.get(F.filter("at", lambda x: x["own"]), F.lit(0))
        place = [own[c].alias(c) for c in ("cell", "ring", "far")]
        turn = F.coalesce("day", F.lit(UNDATED)).alias("turn")
        queries = batch.where("vec is not null").groupBy(*place, "b", "vec", F.col("q").alias("node"), turn).agg(*facts).select(*COLUMNS, "turn", *FACT_COLUMNS)
        pages, twice = self._probe(filled, batch, queries, batch.count())
        # rows without an address are told by their ids alone
        # nulls sort first in a struct: days without a pool row are left out of the least
        bare = batch.where("vec is null").groupBy("q").agg(F.min(F.when(mine.isNotNull(), F.struct("day", "row_no"))).alias("f"), F.min(F.when(F.col("origin") == "ledger", F.col("day"))).alias("listed"), F.count("*").alias("n"))
        nodes = pages.select("q", "node", *FACT_COLUMNS).unionByName(bare.select("q", F.col("q").alias("node"), F.col("f.day").alias("first_day"), F.col("f.row_no").alias("first_row"), "listed", "n"))
        edges = batch.where("a is not null").select("a", "q").distinct().join(nodes.select("q", "node"), "q").select("a", F.col("node").alias("b"))
        linked = lambda df, a, b: df.select(F.unhex(F.md5(F.concat(a, b))).alias("a"), F.explode(F.array(a, b)).alias("b"))
        known = None
        if filled:
            known = self._known(batch, nodes if twice is None else nodes.select("node").unionByName(twice.select(F.col("other").alias("node"))))
            # an id or entry of the batch and the label it had are linked, and so are labels that were merged
            by_id = batch.select("a").distinct().join(known, F.col("a") == F.col("node")).select("a", F.col("label").alias("b"))
            edges = edges.unionByName(linked(known, "node", "label")).unionByName(by_id).unionByName(linked(self.held(spark, "merges"), "a", "b"))
        if twice is not None:
            edges = edges.unionByName(linked(twice, "node", "other"))
        labels = components(edges)
        named = written(nodes.join(labels.withColumnRenamed("b", "node"), "node", "left").withColumn("label", F.coalesce("label", "node")))
        parts = named.select("label", *FACT_COLUMNS)
        if filled:
            firsts = self.held(spark, "firsts").withColumnRenamed("label", "b").join(labels, "b").select("label", "first_day", "first_row", "listed", F.lit(1).cast("bigint").alias("n"))
            parts = parts.unionByName(firsts)
        when = F.when(F.col("first_day").isNotNull(), F.struct("first_day", "first_row"))
        whole = parts.groupBy("label").agg(F.min(when).alias("first"), F.min("listed").alias("listed"), F.sum("n").alias("n"))
        # what occurs once is known from nowhere
        told = named.select("q", "label").join(whole.where("n > 1"), "label").select("q", "first", "listed")
        rows = batch.where("origin = 'pool' and day is not null").select("row_no", "day", "q")
        is_known = (F.col("first") < F.struct(F.col("day").alias("first_day"), F.col("row_no").alias("first_row"))) | (F.col("listed") < F.col("day"))
        found = rows.join(told, "q").where(is_known).select("row_no", F.date_from_unix_date("day").alias("day")).distinct()
        if append:
            found = written(found)
            self._keep(known, pages, batch, named, labels)
        return found

    def _known(self, batch: DataFrame, nodes: DataFrame) -> DataFrame:
        """(node, label) of the batch's ids and entries that the history has."""
        mine = batch.select(F.col("a").alias("node")).where("node is not null").unionByName(nodes.select("node")).distinct()
        return written(self.held(batch.sparkSession, "labels").join(mine, "node", "left_semi"))

    def _keep(self, known: DataFrame | None, pages: DataFrame, batch: DataFrame, named: DataFrame, labels: DataFrame) -> None:
        spark = batch.sparkSession
        ids = batch.where("a is not null").select("a", "q").distinct().join(named.select("q", "label"), "q").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label"))
        nodes = named.select("node", "label").unionByName(ids).groupBy("node").agg(F.min("label").alias("label"))
        if known is not None:
            # the label that a node had before, where the batch gives another
            old = known.select(F.col("label").alias("b")).distinct().join(labels, "b").where("b != label")
            self._append("merges", old.select(F.col("b").alias("a"), F.col("label").alias("b")))
            nodes = nodes.join(known, "node", "left_anti")
        self._append("labels", nodes.select("node", "label"))
        self._append("firsts", named.groupBy("label").agg(
            F.min(F.when(F.col("first_day").isNotNull(), F.struct("first_day", "first_row"))).alias("f"), F.min("listed").alias("listed")
        ).select("label", "f.first_day", "f.first_row", "listed"))
        # in the order of the cells, so that a probe reads few row groups
        self._append("cells", pages.where("opened").select(COLUMNS).sortWithinPartitions("cell", "ring"))
        if known is None:
            self._append("merges", spark.createDataFrame([], self.TABLES["merges"]))


def new_history(pool: DataFrame, centers: np.ndarray | None = None) -> History:
    """An empty history in the shared folder, with centroids of the pool's addresses."""
    return History(f"{shared_dir(pool.sparkSession)}/gleaner/{uuid.uuid4().hex}", fit_centers(pool) if centers is None else centers)


def seen_before(pool: DataFrame, ledger: DataFrame | None, centers: np.ndarray | None = None) -> DataFrame:
    """row_no and day of the pool rows whose page an earlier pool row or the ledger had. The ledger and the rows without a day, of
    which none is a case, are put into new cells; the days are then taken in order against what is persisted."""
    history, dated = new_history(pool, centers), day_of(F.col("first_seen")).isNotNull()
    history.take(pool.where(~dated), ledger)
    return history.take(pool.where(dated))
