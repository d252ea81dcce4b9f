"""Views of the star-schema driver tables in the knowledge-base data model.

Each view is a projection or join of whole tables; ``catalog.twins`` holds the same
definitions as SQL for the side-by-side check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.functions import ident, once, shuffled

REGION, NATION, CUSTOMER, SUPPLIER, PART, ORDER = 1, 2, 3, 4, 5, 6
FAMILIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def qid(kind: int, key: Column | str) -> Column:
    """'Q' plus a number whose billions digit tells the entity kind."""
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("Q"), (F.lit(kind * 1_000_000_000) + key.cast("bigint")).cast("string"))


def day(col: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(col, pattern)


class Driver:
    """Driver tables under one folder, and their knowledge-base views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def spread(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """``df`` dealt out anew: building text per row is CPU work, and a table of one file would do it in one task.

        Dealt by its unique ``key``, the rows need not move again where they meet others by it.
        """
        by = F.col(key) if key else F.xxhash64(F.monotonically_increasing_id())
        return df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), by)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    @cached_property
    def kg_entity(self) -> DataFrame:
        def part(df, kind, key, name, cls):
            return df.select(
                qid(kind, key).alias("ID_WIKIDATA"),
                F.lit(cls).alias("ENTITY_CLASS"),
                name.alias("LABEL_EN"),
                F.lit(f"Q{kind}").alias("CLASS_ID"),
            )

        c = F.col
        order_name = F.when(c("o_orderstatus") != "F", F.concat(F.lit("Order#"), c("o_orderkey").cast("string")))
        parts = [
            part(self.table("region"), REGION, "r_regionkey", c("r_name"), "CLASS"),
            part(self.table("nation"), NATION, "n_nationkey", c("n_name"), "CLASS"),
            part(self.table("customer"), CUSTOMER, "c_custkey", c("c_name"), "PERSON"),
            part(self.table("supplier"), SUPPLIER, "s_suppkey", c("s_name"), "SERIE"),
            part(self.table("part"), PART, "p_partkey", c("p_name"), "ITEM"),
            part(self.table("orders"), ORDER, "o_orderkey", order_name, "MOVIE"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @cached_property
    def kg_subclass(self) -> DataFrame:
        def edge(df, child, parent):
            return df.select(child.alias("ID_CHILD"), parent.alias("ID_PARENT"))

        n = self.table("nation")
        back = n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n_nationkey"))
        return (
            edge(n, qid(NATION, "n_nationkey"), qid(REGION, "n_regionkey"))
            .union(edge(self.table("customer"), qid(CUSTOMER, "c_custkey"), qid(NATION, "c_nationkey")))
            .union(edge(self.table("supplier"), qid(SUPPLIER, "s_suppkey"), qid(NATION, "s_nationkey")))
            .union(edge(self.table("orders"), qid(ORDER, "o_orderkey"), qid(CUSTOMER, "o_custkey")))
            .union(edge(back, qid(REGION, "n_regionkey"), qid(NATION, "n_nationkey")))
        )

    @cached_property
    def kg_class(self) -> DataFrame:
        """P31 memberships; a part has two classes (its type and its brand)."""
        family = F.coalesce(*[F.when(F.col("p_type") == f, F.lit(i + 1)) for i, f in enumerate(FAMILIES)], F.lit(0))
        brand = F.substring("p_brand", 7, 10).cast("bigint")
        p = self.table("part").select(
            qid(PART, "p_partkey").alias("ID_WIKIDATA"), F.explode(F.array(qid(7, family), qid(8, brand))).alias("CLASS_ID")
        )
        rest = self.kg_entity.filter(F.col("ENTITY_CLASS") != "ITEM").select("ID_WIKIDATA", "CLASS_ID")
        return rest.unionByName(p)

    @cached_property
    def kg_fact(self) -> DataFrame:
        """Item statements outside awards: P31 memberships and the P21 trait of orders."""
        trait = self.table("orders").select(
            qid(ORDER, "o_orderkey").alias("ID_WIKIDATA"),
            F.lit("P21").alias("ID_PROPERTY"),
            qid(9, F.substring("o_orderpriority", 1, 1)).alias("ID_ITEM"),
        )
        classes = self.kg_class.select("ID_WIKIDATA", F.lit("P31").alias("ID_PROPERTY"), F.col("CLASS_ID").alias("ID_ITEM"))
        return classes.unionByName(trait)

    @cached_property
    def _line(self) -> DataFrame:
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        guid = F.concat_ws(
            "-",
            F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"),
            day("l_shipdate", "yyyyMMdd"), cents,
        )
        return self.spread(self.table("lineitem")).withColumn("STATEMENT_GUID", guid)

    @cached_property
    def kg_claim(self) -> DataFrame:
        """One statement per lineitem, without what only its order knows."""
        c = F.col
        flag = c("l_returnflag")
        raw_time = day("l_shipdate", "'+'yyyy-MM-dd'T00:00:00Z'")
        amount = c("l_extendedprice").cast("decimal(15,2)")
        return self._line.select(
            ident.statement_id(c("STATEMENT_GUID"), F.lit(""), F.lit("")).alias("ID_STATEMENT"),
            qid(ORDER, "l_orderkey").alias("ID_WIKIDATA"),
            F.when(c("l_linestatus") == "O", "P166").otherwise("P1411").alias("ID_PROPERTY"),
            "STATEMENT_GUID",
            F.when(flag == "A", "item").when(flag == "N", "time").otherwise("quantity").alias("VALUE_TYPE"),
            F.when(flag == "A", qid(PART, "l_partkey")).alias("ID_ITEM"),
            F.when(flag == "N", raw_time).alias("RAW_TIME_VALUE"),
            F.when(flag == "N", F.year("l_shipdate").cast("bigint")).alias("YEAR_VALUE"),
            F.when((flag != "A") & (flag != "N"), amount).alias("AMOUNT"),
            F.when(flag == "A", qid(PART, "l_partkey")).when(flag == "N", raw_time).otherwise(amount.cast("string")).alias("VALUE_TEXT"),
            F.when(c("l_tax") > 0.075, 1).otherwise(0).alias("DELETED"),
            c("l_orderkey"),
            c("l_quantity"),
        )

    @cached_property
    def kg_statement(self) -> DataFrame:
        """Statements with rank and batch, which come from the order."""
        status = F.col("o_orderstatus")
        rank = F.when(status == "P", "preferred").when(status == "O", "normal").otherwise("deprecated")
        o = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            rank.alias("RANK"),
            F.concat(F.lit("batch_"), F.year("o_orderdate").cast("string")).alias("IMPORT_BATCH_ID"),
        )
        return self.kg_claim.join(shuffled(o), "l_orderkey")

    @cached_property
    def kg_qualifier(self) -> DataFrame:
        """Qualifiers of each statement; only some carry a date or a work, some two ordinals."""
        c = F.col

        def q(prop, kind, item, text, year, pos, keep):
            return F.when(
                keep,
                F.struct(
                    F.lit(prop).alias("ID_QUALIFIER_PROPERTY"),
                    F.lit(kind).alias("VALUE_TYPE"),
                    item.alias("ID_ITEM"),
                    text.alias("VALUE_TEXT"),
                    year.alias("YEAR_VALUE"),
                    F.lit(pos).alias("DISPLAY_ORDER"),
                ),
            )

        no_item, no_year = F.lit(None).cast("string"), F.lit(None).cast("bigint")
        work, part = qid(SUPPLIER, "l_suppkey"), qid(PART, "l_partkey")
        number = c("l_linenumber")
        rows = F.array(
            q("P585", "time", no_item, day("l_shipdate", "'+'yyyy-MM-dd'T00:00:00Z'"), F.year("l_shipdate").cast("bigint"), 1, c("l_tax") >= 0.02),
            q("P1686", "item", work, work, no_year, 1, c("l_discount") >= 0.03),
            q("P805", "item", part, part, no_year, 1, F.lit(True)),
            q("P1545", "string", no_item, number.cast("string"), no_year, 1, F.lit(True)),
            q("P1545", "string", no_item, (number + 1).cast("string"), no_year, 2, c("l_quantity").cast("int") % 2 == 0),
        )
        sid = ident.statement_id(c("STATEMENT_GUID"), F.lit(""), F.lit(""))
        base = self._line.select(sid.alias("ID_STATEMENT"), F.explode(rows).alias("q")).filter(c("q").isNotNull()).select("ID_STATEMENT", "q.*")
        snak_hash = F.md5(F.concat_ws("|", "ID_QUALIFIER_PROPERTY", "VALUE_TEXT"))
        return (
            base.withColumn("SNAK_HASH", snak_hash)
            .withColumn("QUALIFIER_HASH", ident.qualifier_hash(c("ID_STATEMENT"), c("ID_QUALIFIER_PROPERTY"), c("SNAK_HASH")))
            .withColumn("ID_STATEMENT_QUALIFIER", ident.stable_bigint(c("QUALIFIER_HASH")))
        )

    @cached_property
    def dump_lines(self) -> DataFrame:
        """The lineitem table as dump text: one entity document with one claim per line."""
        c, lit = F.col, F.lit
        entity = "http://www.wikidata.org/entity/"

        def text(*parts):
            return F.concat(*[lit(p) if isinstance(p, str) else p for p in parts])

        def item(q):
            return text('{"value":{"entity-type":"item","id":"', q, '"},"type":"wikibase-entityid"}')

        time = text(
            '{"value":{"time":"', c("_raw_time"), '","timezone":0,"precision":11,"calendarmodel":"',
            f'{entity}Q1985727"', '},"type":"time"}',
        )
        quantity = text(
            '{"value":{"amount":"+', c("l_extendedprice").cast("decimal(15,2)").cast("string"), f'","unit":"{entity}',
            qid(SUPPLIER, "l_suppkey"), '"},"type":"quantity"}',
        )
        flag = c("l_returnflag")
        datatype = F.when(flag == "A", "wikibase-item").when(flag == "N", "time").otherwise("quantity")
        datavalue = F.when(flag == "A", item(qid(PART, "l_partkey"))).when(flag == "N", c("_time")).otherwise(quantity)

        def snak(prop, kind, key, value):
            digest = F.md5(F.concat_ws("|", lit(prop), key))
            return text('{"snaktype":"value","property":"', prop, '","hash":"', digest, '","datatype":"', kind, '","datavalue":', value, "}")

        def ordinal(n):
            return snak("P1545", "string", n, text('{"value":"', n, '","type":"string"}'))

        first, second = c("l_linenumber").cast("string"), (c("l_linenumber") + 1).cast("string")
        work, part = qid(SUPPLIER, "l_suppkey"), qid(PART, "l_partkey")
        quals = F.concat_ws(
            ",",
            F.when(c("l_tax") >= 0.02, text('"P585":[', snak("P585", "time", c("_raw_time"), c("_time")), "]")),
            F.when(c("l_discount") >= 0.03, text('"P1686":[', snak("P1686", "wikibase-item", work, item(work)), "]")),
            text('"P805":[', snak("P805", "wikibase-item", part, item(part)), "]"),
            text('"P1545":[', F.concat_ws(",", ordinal(first), F.when(c("l_quantity").cast("int") % 2 == 0, ordinal(second))), "]"),
        )
        prop = F.when(c("l_linestatus") == "O", "P166").otherwise("P1411")
        doc = text(
            '{"type":"item","id":"', qid(ORDER, "l_orderkey"), '","claims":{"', prop, '":[{"mainsnak":{"snaktype":"value","property":"', prop,
            '","datatype":"', datatype, '","datavalue":', datavalue, '},"type":"statement","rank":"normal","id":"', c("STATEMENT_GUID"),
            '","qualifiers":{', quals, "}}]}}",
        )
        opening = F.when(c("l_linenumber") == 1, "[").when(c("l_linenumber") == 2, "  ").otherwise("")
        closing = F.when(c("l_linenumber") == 2, " ]").otherwise(",")
        dated = once(self._line, _raw_time=day("l_shipdate", "'+'yyyy-MM-dd'T00:00:00Z'"))
        return once(once(dated, _time=time), value=F.concat(opening, doc, closing)).select("value")

    @cached_property
    def labelled_lines(self) -> DataFrame:
        """Documents as dump lines with a label in their own language and a numeric one."""
        c = F.col
        payload = lambda lang: F.when(c("lang") == lang, F.struct(F.lit(lang).alias("language"), c("text").alias("value")))
        labels = F.struct(
            *[payload(x).alias(x) for x in ("en", "fr", "de", "es")],
            F.struct(F.lit("zz").alias("language"), c("n_chars").alias("value")).alias("zz"),
        )
        return self.table("documents").select(
            F.to_json(F.struct(F.lit("item").alias("type"), qid(0, "doc_id").alias("id"), labels.alias("labels"))).alias("value")
        )

    # Two generations of the same data: orders before 1999, and orders from 1996 on.
    @cached_property
    def v1_entity(self) -> DataFrame:
        o = self.table("orders").filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))
        return self._generation(o, F.lit("MOVIE"), self.table("customer"))

    @cached_property
    def v2_entity(self) -> DataFrame:
        o = self.table("orders").filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp"))
        moved = F.when(F.col("o_orderstatus") == "P", "ITEM").otherwise("MOVIE")
        return self._generation(o, moved, self.table("customer").filter(F.col("c_acctbal") > 0))

    def _generation(self, orders: DataFrame, table: Column, customers: DataFrame) -> DataFrame:
        c = F.col
        films = orders.select(
            qid(ORDER, "o_orderkey").alias("ID_WIKIDATA"), table.alias("ENTITY_CLASS"), F.concat(F.lit("Order#"), c("o_orderkey").cast("string")).alias("LABEL_EN"),
            c("o_orderpriority").alias("INSTANCE_OF"), F.when(c("o_orderstatus") != "F", F.concat(F.lit("tt"), c("o_custkey").cast("string"))).alias("ID_EXTERNAL"),
            F.when(c("o_totalprice") < 5000, 1).otherwise(0).alias("DELETED"),
        )
        people = customers.select(
            qid(CUSTOMER, "c_custkey").alias("ID_WIKIDATA"), F.lit("PERSON").alias("ENTITY_CLASS"), c("c_name").alias("LABEL_EN"),
            c("c_mktsegment").alias("INSTANCE_OF"), F.when(c("c_acctbal") > 5000, F.concat(F.lit("nm"), c("c_custkey").cast("string"))).alias("ID_EXTERNAL"),
            F.lit(0).alias("DELETED"),
        )
        return films.unionByName(people)

    @cached_property
    def v1_triple(self) -> DataFrame:
        """Flat triples of the old generation: every line of an old order, item valued."""
        old = self.table("orders").filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")).select(F.col("o_orderkey").alias("l_orderkey"))
        return (
            self.table("lineitem").join(shuffled(old), "l_orderkey", "left_semi")
            .select(
                qid(ORDER, "l_orderkey").alias("ID_WIKIDATA"),
                F.when(F.col("l_linestatus") == "O", "P166").otherwise("P1411").alias("ID_PROPERTY"),
                qid(PART, "l_partkey").alias("ID_ITEM"),
            )
        )

    @cached_property
    def v2_triple(self) -> DataFrame:
        """Item statements of the new generation."""
        return self.kg_statement.filter((F.col("VALUE_TYPE") == "item") & (F.col("IMPORT_BATCH_ID") >= "batch_1996")).select(
            "ID_STATEMENT", "ID_WIKIDATA", "ID_PROPERTY", "ID_ITEM"
        )

    @cached_property
    def media_statement(self) -> DataFrame:
        """Documents as media file statements of pages, and pages as video ids."""
        c = F.col
        ext = F.get(F.array(*[F.lit(x) for x in ("jpg", "webm", "ogg", "pdf", "PNG", "mp4", "svg", "flac", "djvu", "tif", "mov", "opus", "gif")]), (c("doc_id") % 13).cast("int"))
        name = F.when(c("doc_id") % 17 == 0, F.lit("  ")).when(c("doc_id") % 19 == 0, F.concat(F.lit("plain name "), c("doc_id").cast("string"))).otherwise(
            F.concat(F.lit(" File "), c("source"), F.lit(" "), c("doc_id").cast("string"), F.lit("."), ext)
        )
        docs = self.table("documents").select(
            ident.stable_bigint(F.concat(F.lit("media|"), c("doc_id").cast("string"))).alias("ID_STATEMENT"),
            qid(CUSTOMER, "doc_id").alias("ID_WIKIDATA"), F.lit("P18").alias("ID_PROPERTY"), name.alias("FILE_NAME"), F.lit(None).cast("string").alias("VALUE_EXTERNAL_ID"),
            F.when(c("doc_id") % 11 == 0, "deprecated").when(c("doc_id") % 2 == 0, "normal").alias("RANK"), F.when(c("doc_id") % 23 == 0, 1).otherwise(0).alias("DELETED"),
        )
        page_name = F.substring_index(F.regexp_replace("url", r"[?#].*$", ""), "/", -1)
        pages = self.table("pages").select(
            ident.stable_bigint(F.concat(F.lit("page|"), c("page_id").cast("string"))).alias("ID_STATEMENT"),
            qid(CUSTOMER, "page_id").alias("ID_WIKIDATA"), F.when(c("page_id") % 2 == 0, "P1651").otherwise("P724").alias("ID_PROPERTY"),
            F.lit(None).cast("string").alias("FILE_NAME"), page_name.alias("VALUE_EXTERNAL_ID"),
            F.when(c("page_id") % 7 == 0, "deprecated").otherwise("normal").alias("RANK"), F.lit(0).alias("DELETED"),
        )
        return docs.unionByName(pages)

    # Catalogue payloads: JSON documents built row by row from the tables.
    def _payload(self, df: DataFrame, entity: str, id_: Column, endpoint: str, lang: Column, body: Column) -> DataFrame:
        return self._answers(self.spread(df), entity, id_, endpoint, lang, body)

    def _answers(self, df: DataFrame, entity: str, id_: Column, endpoint: str, lang: Column, body: Column, **json: str) -> DataFrame:
        return df.select(
            F.lit(entity).alias("entity"), id_.cast("bigint").alias("id"), F.lit(endpoint).alias("endpoint"), lang.alias("lang"),
            F.lit("2024-02-01 00:00:00").alias("fetched_at"), F.to_json(body, json).alias("payload"),
        )

    @cached_property
    def movie_payload(self) -> DataFrame:
        """Documents as film payloads: every word of the text is a cast member."""
        return self.movie_answer("details")

    def movie_answer(self, endpoint: str) -> DataFrame:
        """Documents as answers of one endpoint: details with credits, or a list of one item a word of the text.

        A text is split once, and items are zipped from lists of their fields where they can be: a lambda is interpreted word by word.
        """
        c = F.col
        docs = once(self.spread(self.table("documents"), "doc_id"), _words=F.split("text", r"\s+"))
        words = c("_words")
        zipped = lambda **fields: F.arrays_zip(*[x.alias(n) for n, x in fields.items()])
        lengths = F.transform(words, lambda w: F.length(w))
        credit_ids = F.transform(words, lambda w, i: F.concat_ws("-", c("doc_id").cast("string"), i.cast("string")))
        cast = zipped(id=lengths, name=words, credit_id=credit_ids, character=words)
        crew = F.array(
            F.struct((c("n_chars") % 7).alias("id"), c("lang").alias("name"), F.concat(F.lit("c"), c("doc_id").cast("string")).alias("credit_id"), c("lang").alias("department"), c("source").alias("job")),
        )
        genre = F.when(c("n_chars") % 5 == 0, "Documentary").otherwise("Drama")
        lists = {
            "keywords": zipped(id=lengths, name=words).alias("keywords"),
            "similar": zipped(id=lengths).alias("results"),
            "images": F.transform(words, lambda w, i: F.struct(F.concat(F.lit("/"), w).alias("file_path"), F.when(i % 2 == 0, "en").otherwise("fr").alias("iso_639_1"), i.alias("width"))).alias("posters"),
        }
        details = F.struct(
            c("doc_id").alias("id"), c("text").alias("title"), c("text").alias("overview"), (c("n_chars") % 150).alias("runtime"),
            F.when(c("doc_id") % 3 == 0, F.lit("1999-02-30")).when(c("doc_id") % 3 == 1, F.lit("2001-07-04")).otherwise("soon").alias("release_date"),
            (c("n_chars") % 2 == 0).alias("adult"), c("n_chars").alias("budget"),
            F.array(F.struct(F.lit(1).alias("id"), genre.alias("name")), F.struct(F.lit(2).alias("id"), c("source").alias("name"))).alias("genres"),
            zipped(iso_3166_1=words).alias("production_countries"),
            zipped(iso_639_1=words).alias("spoken_languages"),
            F.struct(cast.alias("cast"), crew.alias("crew")).alias("credits"),
        )
        if endpoint in lists:
            return self._answers(docs, "movie", c("doc_id"), endpoint, F.lit("en"), F.struct(c("doc_id").alias("id"), lists[endpoint]))
        # A text that is NULL is answered as null: a field left out would be read as the empty text.
        return self._answers(docs, "movie", c("doc_id"), endpoint, F.lit("en"), details, ignoreNullFields="false")

    @cached_property
    def person_payload(self) -> DataFrame:
        """Customers as person payloads."""
        c = F.col
        k = c("c_custkey")
        credit = lambda media, n: F.struct((k + n).alias("id"), F.concat(F.lit(f"{media}{n}-"), k.cast("string")).alias("credit_id"), c("c_mktsegment").alias("character"), F.lit(media).alias("media_type"))
        body = F.struct(
            k.alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("biography"),
            F.when(k % 4 == 0, F.concat(F.lit("19"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("-0"), (k % 9 + 1).cast("string"), F.lit("-31"))).alias("birthday"),
            (k % 3).alias("gender"), F.when(k % 5 != 0, F.concat(F.lit("  place "), c("c_nationkey").cast("string"), F.lit(" "))).alias("place_of_birth"),
            (c("c_acctbal") > 0).alias("adult"), F.split(c("c_name"), "#").alias("also_known_as"),
            F.struct(F.array(credit("movie", 1), credit("tv", 2)).alias("cast")).alias("combined_credits"),
        )
        return self._payload(self.table("customer"), "person", k, "details", F.lit("en"), body)

    @cached_property
    def release_payload(self) -> DataFrame:
        """Orders as release-date payloads; finished orders answer with a broken entry."""
        c = F.col
        at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'.000Z'")
        release = lambda kind: F.struct(at.alias("release_date"), F.lit(kind).alias("type"), c("o_orderpriority").alias("certification"))
        late = F.struct(F.lit("someday").alias("release_date"), F.lit(4).alias("type"), F.lit(None).cast("string").alias("certification"))
        country = F.when(c("o_orderstatus") != "F", c("o_orderpriority"))
        body = F.struct(F.array(F.struct(country.alias("iso_3166_1"), F.array(release(3), late).alias("release_dates"))).alias("results"))
        return self._payload(self.table("orders"), "movie", c("o_orderkey"), "release_dates", F.lit("en"), body)

    @cached_property
    def watch_payload(self) -> DataFrame:
        """Orders as watch-provider payloads with two countries."""
        c = F.col
        provider = F.array(F.struct(c("o_custkey").alias("provider_id"), c("o_orderpriority").alias("provider_name"), F.lit(1).alias("display_priority")))
        country = F.struct(
            c("o_orderstatus").alias("link"), F.when(c("o_totalprice") > 100000, provider).alias("flatrate"), F.when(c("o_totalprice") > 200000, F.concat(provider, provider)).alias("rent")
        )
        body = F.struct(F.struct(country.alias("FR"), country.alias("USA")).alias("results"))
        return self._payload(self.table("orders"), "movie", c("o_orderkey"), "watch_providers", F.lit("en"), body)

    @cached_property
    def catalog_payload(self) -> DataFrame:
        """Parts as one-provider catalogues: films for even parts, series for every third."""
        c = F.col
        p = self.table("part")
        body = F.struct(
            F.array(
                F.struct(
                    (c("p_partkey") + 1).alias("provider_id"), c("p_name").alias("provider_name"), c("p_brand").alias("logo_path"),
                    F.create_map(F.lit("fr"), c("p_size"), F.lit("us"), c("p_size") + 1).alias("display_priorities"),
                )
            ).alias("results")
        )
        film = self._payload(p.filter(c("p_partkey") % 2 == 0), "providers", c("p_partkey"), "catalog", F.lit("movie"), body)
        serie = self._payload(p.filter(c("p_partkey") % 3 == 0), "providers", c("p_partkey"), "catalog", F.lit("serie"), body)
        return film.unionByName(serie)

    @cached_property
    def video_payload(self) -> DataFrame:
        """Events as video payloads in two requested languages."""
        c = F.col
        at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'")
        video = F.struct(
            F.concat(F.lit("v"), c("event_id").cast("string")).alias("id"), F.when(c("event_type") != "error", at).alias("published_at"), c("event_type").alias("type"),
            F.lit("en").alias("iso_639_1"), c("user_id").cast("int").alias("size"), (c("value") > 10).alias("official"),
        )
        blank = F.struct(
            F.lit("").alias("id"), F.lit("").alias("published_at"), F.lit("").alias("type"), F.lit("").alias("iso_639_1"), F.lit(0).alias("size"), F.lit(False).alias("official")
        )
        lang = F.when(c("event_id") % 2 == 0, "en").otherwise("fr")
        return self._payload(self.table("events"), "movie", c("event_id"), "videos", lang, F.struct(F.array(blank, video).alias("results")))

    @cached_property
    def list_payload(self) -> DataFrame:
        """Conversations as lists: a turn is a page, its words are the members."""
        c = F.col
        items = F.transform(F.split("text", r"\s+"), lambda w: F.struct(F.length(w).alias("id"), F.when(F.length(w) % 2 == 0, "movie").otherwise("tv").alias("media_type")))
        return self._payload(self.table("conversations"), "list", c("conv_id"), "page", F.lit("en"), F.struct((c("turn") + 1).alias("page"), items.alias("items")))

    @cached_property
    def season_payload(self) -> DataFrame:
        """Orders as season payloads with two episodes and both kinds of credits."""
        c = F.col
        k = c("o_orderkey")
        air = F.date_format("o_orderdate", "yyyy-MM-dd")
        person = lambda n, extra: F.struct((k + n).alias("id"), F.concat_ws("-", F.lit(f"p{n}"), k.cast("string")).alias("credit_id"), *extra)
        crew = F.array(person(1, [F.lit("Directing").alias("department"), F.lit("Director").alias("job")]), person(2, [F.lit("Writing").alias("department"), F.lit("Writer").alias("job")]))
        guest = F.array(person(3, [c("o_orderpriority").alias("character"), F.lit(9).alias("order")]))
        episode = lambda n: F.struct((k * 10 + n).alias("id"), air.alias("air_date"), F.concat(F.lit(f"E{n} "), c("o_orderpriority")).alias("name"), F.lit(1).alias("season_number"), F.lit(n).alias("episode_number"), crew.alias("crew"), guest.alias("guest_stars"))
        role = lambda n: F.struct(F.concat_ws("-", F.lit(f"r{n}"), k.cast("string")).alias("credit_id"), c("o_orderstatus").alias("character"), F.lit(n).alias("episode_count"))
        job = lambda n: F.struct(F.concat_ws("-", F.lit(f"j{n}"), k.cast("string")).alias("credit_id"), F.lit("Editor").alias("job"), F.lit(n).alias("episode_count"))
        rich = F.struct(
            F.array(F.struct((k + 1).alias("id"), F.lit(5).alias("order"), F.array(role(1), role(2)).alias("roles"))).alias("cast"),
            F.array(F.struct((k + 2).alias("id"), F.lit("Editing").alias("department"), F.array(job(1)).alias("jobs"))).alias("crew"),
        )
        plain = F.struct(guest.alias("cast"), crew.alias("crew"))
        body = F.struct(
            (k + 1).alias("id"), F.lit(1).alias("season_number"), c("o_orderpriority").alias("name"), air.alias("air_date"), F.array(episode(1), episode(2)).alias("episodes"),
            F.when(c("o_orderstatus") == "O", rich).alias("aggregate_credits"), plain.alias("credits"),
        )
        return self._payload(self.table("orders"), "season", k, "details", F.lit("en"), body)

    @cached_property
    def serie_payload(self) -> DataFrame:
        """Orders as series payloads; the creator is in the crew, in the cast, or in neither."""
        c = F.col
        k = c("o_orderkey")
        person = lambda pid, credit: F.struct(pid.alias("id"), F.concat_ws("-", F.lit(credit), k.cast("string")).alias("credit_id"), F.lit("x").alias("character"), F.lit("D").alias("department"), F.lit("J").alias("job"))
        lit = lambda n: F.lit(n).cast("bigint")
        maker = F.when(c("o_orderstatus") == "O", lit(11)).when(c("o_orderstatus") == "F", lit(1)).otherwise(lit(99))
        body = F.struct(
            k.alias("id"), c("o_orderpriority").alias("name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_air_date"),
            F.when(c("o_orderstatus") != "F", c("o_orderstatus") == "O").alias("in_production"),
            F.when(c("o_orderstatus") == "P", F.struct(F.lit("2024-01-01").alias("air_date"), F.lit(2).alias("season_number"), F.lit(3).alias("episode_number"))).alias("next_episode_to_air"),
            F.struct(c("o_custkey").alias("tvdb_id"), F.lit("tt1").alias("imdb_id")).alias("external_ids"),
            F.array(F.struct(maker.alias("id"), F.concat_ws("-", F.lit("m"), k.cast("string")).alias("credit_id"))).alias("created_by"),
            F.struct(F.array(person(lit(1), "a1"), person(lit(2), "a2")).alias("cast"), F.array(person(lit(10), "b1"), person(lit(11), "b2"), person(lit(10), "b3")).alias("crew")).alias("credits"),
        )
        return self._payload(self.table("orders"), "serie", k, "details", F.lit("en"), body)
