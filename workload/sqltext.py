"""SQL counterparts of the derived snapshot: text form, and typed form without the text detour."""

from __future__ import annotations

FILES = (
    ("title_akas", "alternate titles", "title.akas.tsv.gz", "titleId"),
    ("title_basics", "title basics", "title.basics.tsv.gz", "tconst"),
    ("title_crew", "title crew", "title.crew.tsv.gz", "tconst"),
    ("title_episode", "episodes", "title.episode.tsv.gz", "tconst"),
    ("title_principals", "principal credits", "title.principals.tsv.gz", "tconst"),
    ("title_ratings", "title ratings", "title.ratings.tsv.gz", "tconst"),
    ("name_basics", "people", "name.basics.tsv.gz", "nconst"),
)

TYPE = "CASE o_orderstatus WHEN 'F' THEN 'tvEpisode' WHEN 'O' THEN 'movie' ELSE 'short' END"

TEXT = {
    "title_akas": r"""
SELECT 'ttc' || user_id AS "titleId",
       (hour(ts) * 60 + minute(ts))::VARCHAR AS ordering,
       '"' || props AS title,
       CASE WHEN event_type = 'error' THEN '\N' ELSE 'R' || hour(ts) END AS region,
       CASE WHEN value >= 10 THEN 'pt' ELSE '\N' END AS language,
       CASE WHEN event_type = 'click' THEN '\N' ELSE 'alternative,,' || event_type END AS types,
       CASE WHEN event_type = 'view' THEN event_type ELSE '\N' END AS attributes,
       CASE event_type WHEN 'signup' THEN '1' WHEN 'error' THEN '\N' ELSE '0' END
           AS "isOriginalTitle"
FROM events""",
    "title_basics": rf"""
SELECT 'tto' || o_orderkey AS tconst, {TYPE} AS "titleType",
       o_orderpriority || ' #' || o_orderkey AS "primaryTitle",
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END
           AS "originalTitle",
       CASE WHEN o_orderstatus = 'P' THEN '\N' WHEN o_totalprice > 400000 THEN '1' ELSE '0' END
           AS "isAdult",
       CASE WHEN o_orderpriority = '5-LOW' THEN '\N' ELSE year(o_orderdate)::VARCHAR END
           AS "startYear",
       '\N' AS "endYear",
       floor(o_totalprice / 1000)::INTEGER::VARCHAR AS "runtimeMinutes",
       CASE WHEN o_totalprice < 50000 THEN '\N'
            ELSE o_orderpriority || ',status ' || o_orderstatus
                 || CASE WHEN o_totalprice > 250000 THEN ',large' ELSE '' END END AS genres
FROM orders
UNION ALL
SELECT 'ttc' || c_custkey, 'tvSeries', c_name, c_name, '0', '\N', '\N', '\N', c_mktsegment
FROM customer""",
    "title_crew": r"""
SELECT 'tto' || l_orderkey AS tconst,
       CASE WHEN l_linestatus = 'F' THEN 'nms' || l_suppkey || ',nmp' || l_partkey ELSE '\N' END
           AS directors,
       CASE WHEN l_linestatus = 'F' THEN '\N' ELSE 'nms' || l_suppkey END AS writers
FROM lineitem""",
    "title_episode": r"""
SELECT 'tto' || o_orderkey AS tconst, 'ttc' || o_custkey AS "parentTconst",
       (year(o_orderdate) - 1994)::VARCHAR AS "seasonNumber",
       CASE WHEN o_orderpriority = '5-LOW' THEN '\N' ELSE month(o_orderdate)::VARCHAR END
           AS "episodeNumber"
FROM orders""",
    "title_principals": r"""
SELECT 'tto' || l_orderkey AS tconst, l_linenumber::VARCHAR AS ordering,
       'nmp' || l_partkey AS nconst,
       CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'R' THEN 'self' ELSE 'editor' END AS category,
       CASE WHEN l_linestatus = 'F' THEN 'finished' ELSE '\N' END AS job,
       CASE WHEN l_returnflag = 'N' THEN '\N'
            ELSE '["' || l_returnflag || '","qty ' || l_quantity::INTEGER || '"]' END AS characters
FROM lineitem""",
    "title_ratings": r"""
SELECT 'tto' || l_orderkey AS tconst,
       ((q * 21) // (n * 10)) // 10 || '.' || ((q * 21) // (n * 10)) % 10 AS "averageRating",
       q::VARCHAR AS "numVotes"
FROM (SELECT l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS q, count(*) AS n
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)""",
    "name_basics": r"""
SELECT 'nmp' || p_partkey AS nconst,
       CASE WHEN p_size <= 45 THEN p_name ELSE '\N' END AS "primaryName",
       (p_size * 50)::VARCHAR AS "birthYear",
       CASE WHEN p_size < 30 THEN (p_size * 50 + 40)::VARCHAR ELSE '\N' END AS "deathYear",
       p_brand || ',' || p_type AS "primaryProfession",
       CASE WHEN p_size >= 10 THEN 'ttc' || p_size ELSE '\N' END AS "knownForTitles"
FROM part
UNION ALL
SELECT 'nms' || s_suppkey, s_name, '\N', '\N', 'supplier', '\N'
FROM supplier WHERE s_acctbal > 0""",
}

TYPED = {
    "akas": """
SELECT 'ttc' || user_id AS title_id, (hour(ts) * 60 + minute(ts))::INTEGER AS ordering,
       '"' || props AS title,
       CASE WHEN event_type <> 'error' THEN 'R' || hour(ts) END AS region,
       CASE WHEN value >= 10 THEN 'pt' END AS language,
       CASE event_type WHEN 'signup' THEN true WHEN 'error' THEN NULL ELSE false END
           AS is_original_title,
       CASE WHEN event_type <> 'click' THEN ['alternative', '', event_type] END AS types,
       CASE WHEN event_type = 'view' THEN [event_type] END AS attributes
FROM events""",
    "titles": f"""
SELECT 'tto' || o_orderkey AS tconst, {TYPE} AS title_type,
       o_orderpriority || ' #' || o_orderkey AS primary_title,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END
           AS original_title,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 400000 END AS is_adult,
       CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate)::SMALLINT END AS start_year,
       NULL::SMALLINT AS end_year, floor(o_totalprice / 1000)::INTEGER AS runtime_minutes,
       CASE WHEN o_totalprice > 250000 THEN [o_orderpriority, 'status ' || o_orderstatus, 'large']
            WHEN o_totalprice >= 50000 THEN [o_orderpriority, 'status ' || o_orderstatus] END
           AS genres
FROM orders
UNION ALL
SELECT 'ttc' || c_custkey, 'tvSeries', c_name, c_name, false, NULL, NULL, NULL, [c_mktsegment]
FROM customer""",
    "crew": """
SELECT 'tto' || l_orderkey AS tconst,
       CASE WHEN l_linestatus = 'F' THEN ['nms' || l_suppkey, 'nmp' || l_partkey] END AS directors,
       CASE WHEN l_linestatus <> 'F' THEN ['nms' || l_suppkey] END AS writers
FROM lineitem""",
    "episodes": """
SELECT 'tto' || o_orderkey AS tconst, 'ttc' || o_custkey AS parent_tconst,
       (year(o_orderdate) - 1994)::INTEGER AS season_number,
       CASE WHEN o_orderpriority <> '5-LOW' THEN month(o_orderdate)::INTEGER END AS episode_number
FROM orders""",
    "credits": """
SELECT 'tto' || l_orderkey AS tconst, l_linenumber::INTEGER AS ordering,
       'nmp' || l_partkey AS nconst,
       CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'R' THEN 'self' ELSE 'editor' END AS category,
       CASE WHEN l_linestatus = 'F' THEN 'finished' END AS job,
       CASE WHEN l_returnflag <> 'N' THEN [l_returnflag, 'qty ' || l_quantity::INTEGER] END
           AS characters
FROM lineitem""",
    "ratings": """
SELECT 'tto' || l_orderkey AS tconst,
       ((sum(l_quantity)::BIGINT * 21) // (count(*) * 10)) / 10.0::DOUBLE AS average_rating,
       sum(l_quantity)::BIGINT AS num_votes
FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
    "people": """
SELECT 'nmp' || p_partkey AS nconst, CASE WHEN p_size <= 45 THEN p_name END AS primary_name,
       (p_size * 50)::SMALLINT AS birth_year,
       CASE WHEN p_size < 30 THEN (p_size * 50 + 40)::SMALLINT END AS death_year,
       [p_brand, p_type] AS primary_professions,
       CASE WHEN p_size >= 10 THEN ['ttc' || p_size] END AS known_for_titles
FROM part
UNION ALL
SELECT 'nms' || s_suppkey, s_name, NULL, NULL, ['supplier'], NULL
FROM supplier WHERE s_acctbal > 0""",
}

# Models over the typed tables: needed tables, then the query.
MODELS = {
    "title_genres": (("titles",), "SELECT tconst, unnest(genres) AS genre FROM titles"),
    "crew_links": (
        ("crew",),
        """
SELECT tconst, 'director' AS crew_role, unnest(directors) AS nconst FROM crew
UNION ALL
SELECT tconst, 'writer', unnest(writers) FROM crew""",
    ),
    "genre_lists": (
        ("title_genres",),
        "SELECT tconst, list(genre ORDER BY genre) AS genres FROM title_genres GROUP BY tconst",
    ),
    "director_lists": (
        ("crew_links", "people"),
        """
SELECT tconst, list(shown ORDER BY shown) AS directors
FROM (SELECT DISTINCT c.tconst, coalesce(p.primary_name, c.nconst) AS shown
      FROM crew_links c LEFT JOIN people p ON p.nconst = c.nconst
      WHERE c.crew_role = 'director')
GROUP BY tconst""",
    ),
    "cast_lists": (
        ("credits", "people"),
        """
SELECT tconst, list(shown ORDER BY shown) AS principal_cast
FROM (SELECT DISTINCT c.tconst, coalesce(p.primary_name, c.nconst) AS shown
      FROM credits c LEFT JOIN people p ON p.nconst = c.nconst
      WHERE c.category IN ('actor', 'actress', 'self'))
GROUP BY tconst""",
    ),
    "search": (
        ("titles", "ratings", "genre_lists", "director_lists", "cast_lists"),
        """
SELECT t.* EXCLUDE (genres), r.average_rating, r.num_votes, g.genres, d.directors,
       c.principal_cast
FROM titles t
LEFT JOIN ratings r ON r.tconst = t.tconst
LEFT JOIN genre_lists g ON g.tconst = t.tconst
LEFT JOIN director_lists d ON d.tconst = t.tconst
LEFT JOIN cast_lists c ON c.tconst = t.tconst""",
    ),
    "summary": (
        ("titles", "title_genres", "ratings"),
        """
SELECT t.start_year, t.title_type, g.genre, count(*) AS title_count,
       count(r.average_rating) AS rated_title_count, avg(r.average_rating) AS average_rating,
       sum(coalesce(r.num_votes, 0)) AS total_votes
FROM title_genres g JOIN titles t ON t.tconst = g.tconst
LEFT JOIN ratings r ON r.tconst = g.tconst
GROUP BY ALL""",
    ),
    "filmography": (
        ("credits", "people", "titles", "ratings"),
        """
SELECT p.nconst, p.primary_name, c.tconst, t.primary_title, t.title_type, t.start_year,
       c.ordering, c.category, c.job, c.characters, r.average_rating, r.num_votes
FROM credits c JOIN people p ON p.nconst = c.nconst JOIN titles t ON t.tconst = c.tconst
LEFT JOIN ratings r ON r.tconst = c.tconst""",
    ),
    "series": (
        ("episodes", "titles", "ratings"),
        """
SELECT e.parent_tconst AS series_tconst, s.primary_title AS series_title,
       e.tconst AS episode_tconst, t.primary_title AS episode_title, e.season_number,
       e.episode_number, t.start_year AS episode_start_year, r.average_rating, r.num_votes
FROM episodes e JOIN titles s ON s.tconst = e.parent_tconst JOIN titles t ON t.tconst = e.tconst
LEFT JOIN ratings r ON r.tconst = e.tconst""",
    ),
}


def _needed(name: str, done: dict[str, str]) -> None:
    if name in done:
        return
    if name in TYPED:
        done[name] = TYPED[name]
    elif name in MODELS:
        needs, body = MODELS[name]
        for other in needs:
            _needed(other, done)
        done[name] = body
    elif name.startswith("raw_"):
        done[name] = TEXT[name.removeprefix("raw_")]
    else:
        raise KeyError(name)


def query(tables: str, body: str) -> str:
    """`body` with the named tables (space separated) and all they need in front."""
    done: dict[str, str] = {}
    for name in tables.split():
        _needed(name, done)
    listed = ",\n".join(f"{name} AS ({text}\n)" for name, text in done.items())
    return f"WITH {listed}\n{body}" if listed else body


def entries_sql(load: str | None = None) -> str:
    """Manifest entries measured on the text tables."""
    loaded = f", '{load}' AS _load_id" if load else ""
    parts = [
        f"""SELECT '{dataset}' AS dataset, '{file}' AS file_name, '{name}' AS table_name,
       'https://files.example.org/{file}' AS url,
       coalesce(sum(length("{key}")), 0)::BIGINT AS size_bytes, count(*) AS row_count,
       sha256('{name}:' || count(*)) AS sha256,
       '2026-08-15T00:00:00+00:00' AS downloaded_at, 'batch-' || count(*) AS batch_id,
       NULL::VARCHAR AS etag, NULL::VARCHAR AS last_modified,
       'application/gzip' AS content_type{loaded}
FROM raw_{name}"""
        for name, dataset, file, key in FILES
    ]
    return "\nUNION ALL\n".join(parts)


def files_sql(load: str) -> str:
    """A further table `files`, the staged file rows, for the body of a query over RAW_NAMES."""
    return f", files AS MATERIALIZED (SELECT * EXCLUDE (row_count) FROM ({entries_sql(load)}))\n"


RAW_NAMES = " ".join(f"raw_{name}" for name, *_ in FILES)
