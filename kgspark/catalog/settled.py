"""Snapshot chains that end in stored tables: all four outcomes of every relation."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.operators import merge
from kgspark.plans import settled
from kgspark.plans import snapshots as sn

c = F.col
NOW = "2024-03-01 00:00:00"
#: Payload list, its item field, and the value that stays, the one that comes and the one that goes.
LISTED = {
    "GENRE": ("genres", "id", 1, 3, 2), "PRODUCTION_COUNTRY": ("production_countries", "iso_3166_1", "FR", "US", "DE"), "SPOKEN_LANGUAGE": ("spoken_languages", "iso_639_1", "fr", "en", "de"),
    "COMPANY": ("production_companies", "id", 1, 3, 2), "NETWORK": ("networks", "id", 1, 3, 2),
}
#: Of each endpoint an answer that lists something, an empty one and a malformed one.
ANSWERS = {
    "release_dates": ('{"results":[{"iso_3166_1":"FR","release_dates":[{"release_date":"2001-01-01T00:00:00.000Z","type":3}]}]}', '{"results":[]}', '{"results":[{"iso_3166_1":"FR"}]}'),
    "watch_providers": ('{"results":{"FR":{"link":"l","rent":[{"provider_id":8,"provider_name":"p"}]}}}', '{"results":{}}', '{"results":[]}'),
    "images": ('{"posters":[{"file_path":"/a"},{"file_path":"/n"}]}', '{"posters":[]}', '{"posters":"oops"}'),
    "videos": ('{"results":[{"id":"v1","key":"k"}]}', '{"results":[]}', '{"results":"oops"}'),
    "similar": ('{"results":[{"id":3},{"id":4}]}', '{"results":[]}', '{"results":"oops"}'),
    "keywords": ('{"keywords":[{"id":3,"name":"n"},{"id":5,"name":"n"}]}', '{"keywords":[]}', '{"keywords":"oops"}'),
}
FAILED_ANSWER = '{"status_code":7}'
#: The outcome of an owner's details (k) and of its other endpoints (j): 0 filled, 1 empty, 2 malformed, 3 failed.
OUTCOMES = "SELECT doc_id AS id, doc_id%4 AS k, CASE WHEN doc_id%4=3 THEN 3 ELSE (doc_id//4)%4 END AS j FROM documents"


def _quoted(v):
    return f'"{v}"' if isinstance(v, str) else str(v)


def details(kind):
    """Details with every relation and the credits: filled, empty, malformed."""

    def body(value):
        lists = ",".join(f'"{key}":{value([f"{{{_quoted(field)}:{_quoted(x)}}}" for x in (stays, comes)])}' for key, field, stays, comes, _ in LISTED.values())
        people = value(['{"id":7,"credit_id":"c1","character":"x"}'])
        inner = f'{{"cast":{people},"crew":[]}}' if people != '"oops"' else people
        return f'{{"title":"t","name":"t",{lists},"credits":{inner}}}'

    return body(lambda items: f"[{','.join(items)}]"), body(lambda items: "[]"), body(lambda items: '"oops"')


def chosen(number, answers, failed=FAILED_ANSWER):
    return F.element_at(F.array(*[F.lit(a) for a in (*answers, failed)]), (number + 1).cast("int"))


def answers_of(d, kind):
    """Of every document, as a title: details, and a payload of each other endpoint; French videos of every second one."""
    k, j = c("doc_id") % 4, F.floor(c("doc_id") / 4) % 4

    def rows(endpoint, body, lang="en", of=d.documents):
        return of.select(F.lit(kind).alias("entity"), c("doc_id").alias("id"), F.lit(endpoint).alias("endpoint"), F.lit(lang).alias("lang"), F.lit("2024-02-01").alias("fetched_at"), body.alias("payload"))

    out = rows("details", chosen(k, details(kind), '{"status_code":34}'))
    for endpoint, bodies in ANSWERS.items():
        out = out.union(rows(endpoint, chosen(j, bodies)))
    return out.union(rows("videos", F.lit(ANSWERS["videos"][1]), "fr", d.documents.filter(c("doc_id") % 2 == 0)))


def stored(d, owner, *rows, key="doc_id", of=None):
    """The given rows (structs) of every owner."""
    own = (d.documents if of is None else of).select(c(key).alias(owner))
    return own.withColumn("r", F.explode(F.array(*rows))).select(owner, "r.*")


def row(**values):
    return F.struct(*[F.lit(v).alias(n) for n, v in values.items()])


def no_ledger(d):
    return merge.not_found_ledger(
        d.events.filter(F.lit(False)).select(F.lit("movie").alias("ENTITY_TYPE"), c("user_id").alias("ID_ENTITY"), c("ts").alias("TS"), c("event_id").alias("SEQ"), F.lit("gone").alias("OUTCOME"))
    )


def settled_movies(d, **tables):
    return settled.settle_entity(answers_of(d, "movie"), "movie", no_ledger(d), F.lit(NOW), tables)


@query(
    "settled_relations",
    f"WITH o AS ({OUTCOMES}) "
    + " UNION ALL ".join(
        f"""SELECT 'SERIE_{r}' AS TABLE_NAME, id AS ID_SERIE, v AS "VALUE", n AS DISPLAY_ORDER, a AS DAT_CREAT FROM o, (VALUES ('{stays}',1,'old'),('{comes}',2,NULL)) t(v,n,a) WHERE k=0
            UNION ALL SELECT 'SERIE_{r}', id, v, n, 'old' FROM o, (VALUES ('{stays}',7),('{goes}',8)) t(v,n) WHERE k<>0"""
        for r, (_, _, stays, comes, goes) in LISTED.items()
    ),
)
def settled_relations(d):
    """Genres, countries, languages, companies and networks of series: stale values go, empty lists delete nothing."""
    column = {r: spec[3] for r, spec in sn.RELATIONS.items()}
    tables = {
        f"SERIE_{r}": stored(d, "ID_SERIE", row(**{column[r]: stays, "DISPLAY_ORDER": 7, "DAT_CREAT": "old"}), row(**{column[r]: goes, "DISPLAY_ORDER": 8, "DAT_CREAT": "old"}))
        for r, (_, _, stays, _, goes) in LISTED.items()
    }
    out = settled.settle_entity(answers_of(d, "serie"), "serie", no_ledger(d), F.lit(NOW), tables)
    parts = [out[f"SERIE_{r}"].select(F.lit(f"SERIE_{r}").alias("TABLE_NAME"), "ID_SERIE", c(column[r]).cast("string").alias("VALUE"), "DISPLAY_ORDER", "DAT_CREAT") for r in LISTED]
    return merge.union_rows(*parts)


@query("settled_release_dates", f"WITH o AS ({OUTCOMES}) SELECT id AS ID_MOVIE, CASE j WHEN 0 THEN 'FR' ELSE 'DE' END AS COUNTRY_CODE, CASE j WHEN 0 THEN 3 ELSE 9 END AS RELEASE_TYPE FROM o WHERE j<>1")
def settled_release_dates(d):
    """A valid answer replaces the whole snapshot, an empty one clears it, others leave it."""
    return settled_movies(d, MOVIE_RELEASE_DATE=stored(d, "ID_MOVIE", row(COUNTRY_CODE="DE", RELEASE_TYPE=9)))["MOVIE_RELEASE_DATE"]


@query(
    "settled_watch_providers",
    f"WITH o AS ({OUTCOMES}) SELECT id AS ID_MOVIE, CASE j WHEN 0 THEN 'FR' ELSE 'DE' END AS COUNTRY_CODE, CASE j WHEN 0 THEN 'rent' ELSE 'buy' END AS MONETIZATION_TYPE, CASE j WHEN 0 THEN 8 ELSE 9 END::BIGINT AS ID_PROVIDER FROM o WHERE j<>1",
)
def settled_watch_providers(d):
    old = stored(d, "ID_MOVIE", row(COUNTRY_CODE="DE", MONETIZATION_TYPE="buy", ID_PROVIDER=9))
    return settled_movies(d, MOVIE_WATCH_PROVIDER=old.withColumn("ID_PROVIDER", c("ID_PROVIDER").cast("bigint")))["MOVIE_WATCH_PROVIDER"]


@query(
    "settled_images",
    f"""WITH o AS ({OUTCOMES}) SELECT id AS ID_MOVIE, t AS TYPE_IMAGE, p AS IMAGE_PATH, n AS DISPLAY_ORDER, x AS NOTE FROM o, (VALUES ('poster','/a',1,'old'),('poster','/n',2,NULL),('backdrop','/n',7,'old')) v(t,p,n,x) WHERE j=0
        UNION ALL SELECT id, t, p, n, 'old' FROM o, (VALUES ('poster','/a',5),('poster','/stale',6),('backdrop','/n',7)) v(t,p,n) WHERE j>1""",
)
def settled_images(d):
    """A path that is listed under another type keeps its old row; an empty answer deletes all."""
    old = [row(TYPE_IMAGE=t, IMAGE_PATH=p, DISPLAY_ORDER=n, NOTE="old") for t, p, n in (("poster", "/a", 5), ("poster", "/stale", 6), ("backdrop", "/n", 7))]
    return settled_movies(d, MOVIE_IMAGE=stored(d, "ID_MOVIE", *old))["MOVIE_IMAGE"]


@query(
    "settled_videos",
    f"""WITH o AS ({OUTCOMES}) SELECT id AS ID_MOVIE, 'en' AS LANG_REQUESTED, 'v1' AS ID_CREDIT, 'k' AS VIDEO_KEY FROM o WHERE j=0 UNION ALL SELECT id, 'en', v, 'o' FROM o, (VALUES ('v0'),('v1')) t(v) WHERE j>1
        UNION ALL SELECT id, 'fr', 'v0', 'o' FROM o WHERE id%2=1 OR k=3""",
)
def settled_videos(d):
    """Videos are pruned by the language that was asked for."""
    old = [row(LANG_REQUESTED=lang, ID_CREDIT=v, VIDEO_KEY="o") for lang, v in (("en", "v0"), ("en", "v1"), ("fr", "v0"))]
    return settled_movies(d, MOVIE_VIDEO=stored(d, "ID_MOVIE", *old))["MOVIE_VIDEO"]


@query(
    "settled_links",
    f"""WITH o AS ({OUTCOMES}) SELECT 'credit' AS KIND, id AS ID_MOVIE, 'c1' AS LINK FROM o WHERE k=0 UNION ALL SELECT 'credit', id, v FROM o, (VALUES ('c0'),('c1')) t(v) WHERE k>1
        UNION ALL SELECT 'similar', id, v FROM o, (VALUES ('3'),('4'),('9')) t(v) WHERE CASE WHEN j=0 THEN v<>'9' ELSE v<>'4' END UNION ALL SELECT 'keyword', id, v FROM o, (VALUES ('3'),('5'),('9')) t(v) WHERE j=0 OR v<>'5'""",
)
def settled_links(d):
    """Credits are cleared by an empty answer, neighbours are not, keywords never go."""
    number = lambda df, n: df.withColumn(n, c(n).cast("bigint"))
    out = settled_movies(
        d, PERSON_MOVIE=stored(d, "ID_MOVIE", row(ID_CREDIT="c1", CREW_JOB=""), row(ID_CREDIT="c0", CREW_JOB="")),
        MOVIE_SIMILAR=number(stored(d, "ID_MOVIE", row(ID_NEIGHBOUR=3), row(ID_NEIGHBOUR=9)), "ID_NEIGHBOUR"), MOVIE_KEYWORD=number(stored(d, "ID_MOVIE", row(ID_KEYWORD=3), row(ID_KEYWORD=9)), "ID_KEYWORD"),
    )
    named = {"credit": ("PERSON_MOVIE", "ID_CREDIT"), "similar": ("MOVIE_SIMILAR", "ID_NEIGHBOUR"), "keyword": ("MOVIE_KEYWORD", "ID_KEYWORD")}
    return merge.union_rows(*[out[t].select(F.lit(k).alias("KIND"), "ID_MOVIE", c(col).cast("string").alias("LINK")) for k, (t, col) in named.items()])


@query(
    "settled_stamps",
    f"""WITH o AS ({OUTCOMES}) SELECT id AS ID_MOVIE, CASE WHEN k=3 THEN 'old' ELSE 't' END AS TITLE, CASE WHEN k<2 THEN '{NOW}' ELSE 'old' END AS TIM_CREDITS_COMPLETED, CASE WHEN j<2 THEN '{NOW}' ELSE 'old' END AS TIM_IMAGES_COMPLETED,
        CASE WHEN j<2 OR (k<>3 AND id%2=0) THEN '{NOW}' ELSE 'old' END AS TIM_VIDEOS_COMPLETED, CASE WHEN j<2 THEN '{NOW}' ELSE 'old' END AS TIM_RELEASE_DATES_COMPLETED FROM o""",
)
def settled_stamps(d):
    """The film row of the same chain: an unusable answer leaves the completion time of its table."""
    names = ("TITLE", "TIM_CREDITS_COMPLETED", "TIM_IMAGES_COMPLETED", "TIM_VIDEOS_COMPLETED", "TIM_RELEASE_DATES_COMPLETED")
    return settled_movies(d, MOVIE=stored(d, "ID_MOVIE", row(**{n: "old" for n in names})))["MOVIE"]


LISTS = "SELECT DISTINCT conv_id AS id, conv_id%4 AS k FROM conversations"


@query(
    "settled_list_members",
    f"""WITH o AS ({LISTS}) SELECT id AS ID_LIST, kind AS KIND, v::BIGINT AS ID_TITLE, n AS DISPLAY_ORDER FROM o, (VALUES ('movie',1,1),('serie',2,2)) t(kind,v,n) WHERE k=0 UNION ALL SELECT id, kind, v, n FROM o, (VALUES ('movie',1,1),('movie',5,2),('serie',1,9)) t(kind,v,n) WHERE k=1
        UNION ALL SELECT id, kind, v, n FROM o, (VALUES ('movie',1,7),('movie',9,8),('serie',1,9)) t(kind,v,n) WHERE k>1""",
)
def settled_list_members(d):
    """Films and series of a list are pruned apart; a list of which a page is missing, or malformed, keeps its members."""
    lists = d.conversations.select("conv_id").distinct()
    bodies = (
        '{"page":1,"total_pages":1,"items":[{"id":1,"media_type":"movie"},{"id":2,"media_type":"tv"}]}', '{"page":1,"total_pages":1,"items":[{"id":1,"media_type":"movie"},{"id":5,"media_type":"movie"}]}',
        '{"page":1,"total_pages":1,"items":"oops"}',
    )
    body = chosen(c("conv_id") % 4, bodies, '{"page":1,"total_pages":2,"items":[{"id":1,"media_type":"movie"}]}')
    pages = lists.select(F.lit("list").alias("entity"), c("conv_id").alias("id"), F.lit("page").alias("endpoint"), F.lit("en").alias("lang"), F.lit("2024-02-01").alias("fetched_at"), body.alias("payload"))
    old = stored(d, "ID_LIST", *[row(KIND=k, ID_TITLE=v, DISPLAY_ORDER=n) for k, v, n in (("movie", 1, 7), ("movie", 9, 8), ("serie", 1, 9))], key="conv_id", of=lists)
    tables = {"LIST_MEMBER": old.withColumn("ID_TITLE", c("ID_TITLE").cast("bigint"))}
    return settled.settle_entity(pages, "list", no_ledger(d), F.lit(NOW), tables)["LIST_MEMBER"]


@query(
    "merged_episode_credits",
    """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders) SELECT k*10+1 AS ID_EPISODE, 'f1' AS ID_CREDIT, 'full' AS CAST_CHARACTER FROM o WHERE s='F' UNION ALL SELECT k*10+1, v, 'old' FROM o, (VALUES ('a'),('b')) t(v) WHERE s='O'
       UNION ALL SELECT k*10+n, 'p'||i||'-'||k, CASE i WHEN 3 THEN o_orderpriority ELSE '' END FROM o JOIN orders ON o_orderkey=k, (VALUES (1),(2)) e(n), (VALUES (1),(2),(3)) p(i) WHERE k+i<>0 AND (n=2 OR s='O')""",
)
def merged_episode_credits(d):
    """The first episode of an order has full credits, an empty answer or none; what only the season's payload gave then goes, or stays."""
    body = F.when(c("o_orderstatus") == "F", '{"cast":[{"id":5,"credit_id":"f1","character":"full"}],"crew":[]}').when(c("o_orderstatus") == "P", '{"cast":[],"crew":[],"guest_stars":[]}').otherwise(FAILED_ANSWER)
    answers = d.orders.select(F.lit("episode").alias("entity"), (c("o_orderkey") * 10 + 1).alias("id"), F.lit("credits").alias("endpoint"), F.lit("en").alias("lang"), F.lit("2024-02-01").alias("fetched_at"), body.alias("payload"))
    full = sn.with_fields(answers)
    old = d.orders.select((c("o_orderkey") * 10 + 1).alias("ID_EPISODE"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("ID_CREDIT"), F.lit("old").alias("CAST_CHARACTER"))
    return settled.merged_episode_credits(old, sn.episode_credits(d.season_payload, "season"), sn.episode_credits(full), settled.outcomes(full, "episode"))
