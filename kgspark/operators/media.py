"""Media resolution: statement values to playable resources and their URLs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.functions.ident import stable_bigint
from kgspark.functions.text import active, enum_guard, not_deprecated

# Kind by file extension; everything else is an image.
KIND_BY_EXTENSION = {
    "video": ("webm", "mp4", "ogv", "mov", "mkv"),
    "audio": ("wav", "mp3", "oga", "ogg", "opus", "flac"),
    "document": ("pdf", "djvu"),
}
PLATFORM_PROPERTY = {"youtube": "P1651", "internet_archive": "P724"}

# Allowed sets and defaults of externally produced rows.
RESOURCE_ENUMS = {
    "SOURCE_PLATFORM": (("commons", "internet_archive", "youtube"), None),
    "RESOURCE_KIND": (("video", "audio", "image", "document"), "video"),
    "CONTENT_ROLE": (("full", "trailer", "excerpt", "clip", "interview", "unknown"), "unknown"),
    "CONTENT_SCOPE": (("main_work", "related_material", "promotional", "archival", "unknown"), "unknown"),
    "RESOLUTION_STATUS": (("resolved", "partial", "failed", "pending", "obsolete"), "pending"),
}
URL_ENUMS = {
    "URL_TYPE": (("page", "watch", "embed", "file", "thumbnail", "metadata", "manifest", "subtitle", "transcript"), None)
}
CHECK_ENUMS = {
    "CHECK_SCOPE": (("resource", "url"), None),
    "CHECK_TYPE": (
        ("resolve", "api_lookup", "http_head", "http_get", "redirect_trace", "playability_check", "embed_check", "metadata_refresh"),
        None,
    ),
    "CHECK_STATUS": (("success", "partial", "failure"), None),
}
RESOURCE_FLAGS = {"IS_PREFERRED_RESOURCE": 0, "IS_PRIMARY_FOR_ENTITY": 0, "IS_PLAYABLE": 0, "IS_DOWNLOADABLE": 0, "IS_EMBEDDABLE": 0, "IS_ACTIVE": 1, "DELETED": 0}
URL_FLAGS = {"IS_CANONICAL": 0, "IS_PREFERRED": 0, "IS_DIRECT_FILE": 0, "IS_ACTIVE": 1, "IS_PLAYABLE": 0, "IS_DOWNLOADABLE": 0, "IS_EMBEDDABLE": 0, "DELETED": 0}


URL_COUNTERS = {"CHECK_COUNT": 0, "FAIL_COUNT": 0}


def guard_rows(staged: DataFrame, enums: dict, flags: dict, now: Column, stamps: tuple[str, ...] = ()) -> DataFrame:
    """Staged rows with enum guards and flag and date defaults applied."""
    out = staged
    for name, (allowed, default) in enums.items():
        if name in staged.columns:
            out = out.withColumn(name, enum_guard(F.col(name), allowed, default))
    for name, default in flags.items():
        if name in staged.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    for name in stamps:
        if name in staged.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), now))
    return out


def resource_kind(extension: Column) -> Column:
    out = None
    for kind, extensions in KIND_BY_EXTENSION.items():
        hit = extension.isin(*extensions)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("image")


def _live_subjects(stmts: DataFrame, served: DataFrame) -> DataFrame:
    """Live statements about served entities.

    ``served`` is the union of the live ids of the served tables: one semi join, where
    an OR of three EXISTS would cost three.
    """
    ids = served.select(F.col(served.columns[0]).alias("ID_WIKIDATA")).distinct()
    live = stmts.filter(active(F.col("DELETED")) & not_deprecated(F.col("RANK")))
    return live.join(ids, "ID_WIKIDATA", "left_semi")


_RESOURCE_COLUMNS = (
    "ID_MEDIA_RESOURCE", "ID_STATEMENT", "ID_WIKIDATA", "ID_PROPERTY", "SOURCE_PLATFORM", "SOURCE_IDENTIFIER",
    "SOURCE_IDENTIFIER_NORMALIZED", "RESOURCE_KEY", "RESOURCE_KIND", "CONTENT_ROLE", "CONTENT_SCOPE", "RESOURCE_TITLE",
    "FILE_EXTENSION_PRIMARY", "IS_PLAYABLE", "IS_DOWNLOADABLE", "IS_EMBEDDABLE", "IS_ACTIVE", "RESOLUTION_STATUS",
    "RESOLUTION_METHOD", "IMPORT_BATCH_ID", "DELETED",
)


def _resources(rows: DataFrame, platform: str, batch: str, kind: Column, playable: Column, downloadable: int, embeddable: int, title: Column, extension: Column) -> DataFrame:
    key = F.concat(
        F.lit(f"{platform}:"), F.left("norm", F.lit(200)), F.lit(":S"), F.col("ID_STATEMENT").cast("string")
    )
    return rows.withColumn("RESOURCE_KEY", key).select(
        stable_bigint(F.col("RESOURCE_KEY")).alias("ID_MEDIA_RESOURCE"),
        "ID_STATEMENT",
        "ID_WIKIDATA",
        "ID_PROPERTY",
        F.lit(platform).alias("SOURCE_PLATFORM"),
        F.col("name").alias("SOURCE_IDENTIFIER"),
        F.col("norm").alias("SOURCE_IDENTIFIER_NORMALIZED"),
        "RESOURCE_KEY",
        kind.alias("RESOURCE_KIND"),
        F.lit("unknown").alias("CONTENT_ROLE"),
        F.lit("unknown").alias("CONTENT_SCOPE"),
        title.alias("RESOURCE_TITLE"),
        extension.alias("FILE_EXTENSION_PRIMARY"),
        playable.alias("IS_PLAYABLE"),
        F.lit(downloadable).alias("IS_DOWNLOADABLE"),
        F.lit(embeddable).alias("IS_EMBEDDABLE"),
        F.lit(1).alias("IS_ACTIVE"),
        F.lit("resolved").alias("RESOLUTION_STATUS"),
        F.lit("url_pattern").alias("RESOLUTION_METHOD"),
        F.lit(batch).alias("IMPORT_BATCH_ID"),
        F.lit(0).alias("DELETED"),
    )


def commons_resources(stmts: DataFrame, values: DataFrame, served: DataFrame, batch: str) -> DataFrame:
    """One resource per live media statement of a served entity."""
    joined = _live_subjects(stmts, served).join(values.select("ID_STATEMENT", "FILE_NAME"), "ID_STATEMENT")
    name = F.trim("FILE_NAME")
    rows = (
        joined.withColumn("name", name)
        .filter(F.coalesce(F.col("name"), F.lit("")) != "")
        .withColumn("norm", F.replace("name", F.lit(" "), F.lit("_")))
        .withColumn("ext", F.lower(F.substring_index("name", ".", -1)))
        .withColumn("kind", resource_kind(F.col("ext")))
    )
    playable = F.when(F.col("kind").isin("video", "audio"), 1).otherwise(0)
    return _resources(rows, "commons", batch, F.col("kind"), playable, 1, 0, F.col("name"), F.col("ext"))


def _external(stmts: DataFrame, values: DataFrame, served: DataFrame, platform: str, batch: str, downloadable: int) -> DataFrame:
    mine = _live_subjects(stmts.filter(F.col("ID_PROPERTY") == PLATFORM_PROPERTY[platform]), served)
    rows = (
        mine.join(values.select("ID_STATEMENT", "VALUE_EXTERNAL_ID"), "ID_STATEMENT")
        .withColumn("name", F.trim("VALUE_EXTERNAL_ID"))
        .filter(F.coalesce(F.col("name"), F.lit("")) != "")
        .withColumn("norm", F.col("name"))
    )
    none = F.lit(None).cast("string")
    return _resources(rows, platform, batch, F.lit("video"), F.lit(1), downloadable, 1, none, none)


def youtube_resources(stmts: DataFrame, values: DataFrame, served: DataFrame, batch: str) -> DataFrame:
    return _external(stmts, values, served, "youtube", batch, 0)


def internet_archive_resources(stmts: DataFrame, values: DataFrame, served: DataFrame, batch: str) -> DataFrame:
    return _external(stmts, values, served, "internet_archive", batch, 1)


def _url(kind: str, url: Column, order: int, canonical: int, direct: int, playable: Column | int, downloadable: int, embeddable: int, mime: str | None = None, ext: Column | None = None) -> Column:
    number = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(kind).alias("URL_TYPE"),
        url.alias("URL"),
        F.lit(canonical).alias("IS_CANONICAL"),
        F.lit(canonical).alias("IS_PREFERRED"),
        F.lit(direct).alias("IS_DIRECT_FILE"),
        number(playable).alias("IS_PLAYABLE"),
        F.lit(downloadable).alias("IS_DOWNLOADABLE"),
        F.lit(embeddable).alias("IS_EMBEDDABLE"),
        F.lit(order).alias("DISPLAY_ORDER"),
        F.lit(mime).cast("string").alias("MIME_TYPE"),
        (F.lit(None) if ext is None else ext).cast("string").alias("FILE_EXTENSION"),
    )


def _exploded(resources: DataFrame, platform: str, *urls: Column) -> DataFrame:
    mine = resources.filter((F.col("SOURCE_PLATFORM") == platform) & active(F.col("DELETED")))
    rows = mine.select("ID_MEDIA_RESOURCE", F.explode(F.array(*urls)).alias("u")).select("ID_MEDIA_RESOURCE", "u.*")
    url_hash = F.sha2("URL", 256)
    return rows.select(
        stable_bigint(F.concat_ws("|", F.col("ID_MEDIA_RESOURCE").cast("string"), url_hash)).alias("ID_MEDIA_RESOURCE_URL"),
        "ID_MEDIA_RESOURCE",
        "URL_TYPE",
        "URL",
        F.col("URL").alias("URL_NORMALIZED"),
        url_hash.alias("URL_HASH"),
        "IS_CANONICAL",
        "IS_PREFERRED",
        "IS_DIRECT_FILE",
        F.lit(1).alias("IS_ACTIVE"),
        "IS_PLAYABLE",
        "IS_DOWNLOADABLE",
        "IS_EMBEDDABLE",
        "DISPLAY_ORDER",
        "MIME_TYPE",
        "FILE_EXTENSION",
        F.lit(0).alias("DELETED"),
    )


def commons_urls(resources: DataFrame) -> DataFrame:
    """Description page, thumbnail and original file; the path comes from the name's MD5."""
    name = F.replace(F.trim("SOURCE_IDENTIFIER"), F.lit(" "), F.lit("_"))
    digest = F.md5(name)
    file_url = F.concat(
        F.lit("https://upload.wikimedia.org/wikipedia/commons/"),
        F.left(digest, F.lit(1)), F.lit("/"), F.left(digest, F.lit(2)), F.lit("/"), name,
    )
    playable = F.when(F.col("RESOURCE_KIND").isin("video", "audio"), 1).otherwise(0)
    return _exploded(
        resources,
        "commons",
        _url("page", F.concat(F.lit("https://commons.wikimedia.org/wiki/File:"), name), 1, 1, 0, 0, 0, 0),
        _url("thumbnail", F.concat(F.lit("https://commons.wikimedia.org/wiki/Special:FilePath/"), name, F.lit("?width=400")), 2, 0, 0, 0, 0, 0, "image/jpeg"),
        _url("file", file_url, 3, 0, 1, playable, 1, 0, ext=F.col("FILE_EXTENSION_PRIMARY")),
    )


def youtube_urls(resources: DataFrame) -> DataFrame:
    video = F.trim("SOURCE_IDENTIFIER")
    return _exploded(
        resources,
        "youtube",
        _url("watch", F.concat(F.lit("https://www.youtube.com/watch?v="), video), 1, 1, 0, 1, 0, 0),
        _url("embed", F.concat(F.lit("https://www.youtube.com/embed/"), video), 2, 0, 0, 1, 0, 1),
        _url("thumbnail", F.concat(F.lit("https://i.ytimg.com/vi/"), video, F.lit("/hqdefault.jpg")), 3, 0, 0, 0, 0, 0, "image/jpeg"),
    )


def internet_archive_urls(resources: DataFrame) -> DataFrame:
    item = F.trim("SOURCE_IDENTIFIER")
    return _exploded(
        resources,
        "internet_archive",
        _url("page", F.concat(F.lit("https://archive.org/details/"), item), 1, 1, 0, 1, 0, 0),
        _url("file", F.concat(F.lit("https://archive.org/download/"), item), 2, 0, 1, 0, 1, 0),
    )


# On a re-run only these columns of an existing resource / URL change (plus DELETED = 0).
RESOURCE_UPDATES = ("RESOURCE_KIND", "RESOURCE_TITLE", "FILE_EXTENSION_PRIMARY", "IS_PLAYABLE", "IS_ACTIVE", "RESOLUTION_STATUS", "RESOLUTION_METHOD", "IMPORT_BATCH_ID", "DELETED")
URL_UPDATES = ("URL", "URL_NORMALIZED", "IS_CANONICAL", "IS_PREFERRED", "IS_PLAYABLE", "MIME_TYPE", "FILE_EXTENSION", "IS_ACTIVE", "DELETED")


def merge_resolved(target: DataFrame, resolved: DataFrame, key: str, updates: tuple[str, ...]) -> DataFrame:
    """Upsert that refreshes only ``updates`` on existing rows."""
    from kgspark.operators.merge import upsert

    frozen = {c: "insert_only" for c in target.columns if c != key and c not in updates}
    return upsert(target, resolved, [key], frozen)


# Externally produced rows: staged, guarded, loaded.
KEYS = {"MEDIA_RESOURCE": "ID_MEDIA_RESOURCE", "MEDIA_RESOURCE_URL": "ID_MEDIA_RESOURCE_URL", "MEDIA_RESOURCE_CHECK": "ID_MEDIA_RESOURCE_CHECK"}
GUARDS = {
    "MEDIA_RESOURCE": (RESOURCE_ENUMS, RESOURCE_FLAGS, ("DISCOVERED_AT", "TIM_UPDATED")),
    "MEDIA_RESOURCE_URL": (URL_ENUMS, URL_FLAGS | URL_COUNTERS, ("DISCOVERED_AT", "TIM_UPDATED")),
    "MEDIA_RESOURCE_CHECK": (CHECK_ENUMS, {}, ("CHECKED_AT",)),
}


def load_staged(targets: Mapping[str, DataFrame], staging: Mapping[str, DataFrame], batch: str, now: Column) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(targets, staging) after loading a batch's resources, URLs and checks that outside tools produced.

    Values outside the allowed sets and missing flags, counters and times get their defaults; a row that is there is
    overwritten and stamped anew. Check rows have no stamp of their own: a check that comes again replaces itself.
    """
    from kgspark.operators.merge import loadable, mark_loaded, upsert

    out, left = dict(targets), dict(staging)
    for name, (enums, flags, stamps) in GUARDS.items():
        if name not in staging:
            continue
        rows = guard_rows(loadable(staging[name], batch), enums, flags, now, stamps)
        order = [c for c in ("ID_STG_ROW",) if c in rows.columns]
        out[name] = upsert(targets[name], rows, [KEYS[name]], {"TIM_UPDATED": "now_on_update"}, now, order or None)
        left[name] = mark_loaded(staging[name], batch)
    return out, left


def append_checks(checks: DataFrame, folder: str, batch: str, now: Column) -> None:
    """Add a batch's check rows to the history: a partition of their own, which alone is rewritten when the batch comes again."""
    from kgspark.sources.tables import replace_batch

    enums, flags, stamps = GUARDS["MEDIA_RESOURCE_CHECK"]
    replace_batch(guard_rows(checks, enums, flags, now, stamps).drop("IMPORT_BATCH_ID"), folder, batch)


def check_history(spark: SparkSession, folder: str) -> DataFrame:
    """Every check once: of one that several batches bring, the last batch's row."""
    from kgspark.operators.ranking import latest_wins

    rows = spark.read.option("basePath", folder).parquet(folder)
    return latest_wins(rows.withColumn("IMPORT_BATCH_ID", F.col("IMPORT_BATCH_ID").cast("string")), ["ID_MEDIA_RESOURCE_CHECK"], ["IMPORT_BATCH_ID"])


def newest_checks(history: DataFrame) -> DataFrame:
    """The state of every URL after its last check, with the counters that the history gives.

    CHECK_STATUS and HTTP_STATUS are those of the last check (ties by the check's id), LAST_SUCCESS_AT that of the last
    success; checks of a resource as a whole have a NULL URL. Aggregates only, so a URL with a long history costs no task.
    """
    last = F.max_by(F.struct("CHECK_STATUS", "HTTP_STATUS"), F.struct("CHECKED_AT", "ID_MEDIA_RESOURCE_CHECK"))
    found = history.groupBy("ID_MEDIA_RESOURCE", "ID_MEDIA_RESOURCE_URL").agg(
        last.alias("_last"), F.count(F.lit(1)).alias("CHECK_COUNT"), F.count_if(F.col("CHECK_STATUS") == "failure").alias("FAIL_COUNT"), F.max("CHECKED_AT").alias("LAST_CHECKED_AT"),
        F.max(F.when(F.col("CHECK_STATUS") == "success", F.col("CHECKED_AT"))).alias("LAST_SUCCESS_AT"),
    )
    return found.select("ID_MEDIA_RESOURCE", "ID_MEDIA_RESOURCE_URL", "_last.*", "CHECK_COUNT", "FAIL_COUNT", "LAST_CHECKED_AT", "LAST_SUCCESS_AT")


def with_check_state(urls: DataFrame, newest: DataFrame) -> DataFrame:
    """URL rows with the counters and times of their checks; a URL without any check keeps its own."""
    columns = [c for c in ("HTTP_STATUS", "CHECK_COUNT", "FAIL_COUNT", "LAST_CHECKED_AT", "LAST_SUCCESS_AT") if c in urls.columns]
    state = newest.filter(F.col("ID_MEDIA_RESOURCE_URL").isNotNull()).select("ID_MEDIA_RESOURCE_URL", F.lit(True).alias("_seen"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = urls.join(state, "ID_MEDIA_RESOURCE_URL", "left")
    return joined.select(*[F.when(F.col("_seen"), F.col(f"_{c}")).otherwise(F.col(c)).cast(urls.schema[c].dataType).alias(c) if c in columns else F.col(c) for c in urls.columns])
