"""DuckDB SQL oracles: the same results written independently as SQL.

Tables ``documents`` etc. are views over the test parquet files.  The CTEs
below restate the fixture rules of ``tessera.sources.fixtures``; text folding
uses DuckDB's own ``strip_accents`` (an independent implementation of the
same transliteration on the letters present in the data).  The merge is
written the textbook way (window ``row_number`` picks, joins, ``string_agg``),
not the way the Spark plan computes it.
"""

from __future__ import annotations

RUN_DATE = "20240103"
STRIP = r"'^\s+|\s+$'"


def fold(x: str) -> str:
    return f"upper(strip_accents(replace({x}, 'ß', 'ss')))"


DAY = "lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0')"

#: Documents of both sides, and all of them for queries on one side.
NEW_SIDE, OLD_SIDE, EVERY = "d.doc_id % 7 <> 3", "(doc_id % 13 <> 5 OR doc_id % 7 = 3)", "true"


def bronze_cte(which: str) -> str:
    return f"""
bronze_src AS (
  SELECT d.*, t.dup,
         CASE WHEN d.doc_id % 97 = 0 THEN NULL ELSE CAST(d.doc_id AS VARCHAR) END AS rid
  FROM documents d, (VALUES (0), (1)) t(dup)
  WHERE {which} AND (t.dup = 0 OR d.doc_id % 29 = 4)
),
bronze AS (
  SELECT 'avatar' || rid AS avatar,
         '2024-02-' || {DAY} AS date,
         rid AS id,
         '2024-02-' || {DAY} || CASE WHEN dup = 1 THEN 'T12:00:00Z' ELSE 'T00:00:00Z' END AS iso_date,
         doc_id % 300 AS likes,
         CASE WHEN doc_id % 23 = 0 THEN NULL ELSE CAST(1 + (doc_id + dup) % 5 AS DOUBLE) + 0.75 END AS rating,
         text AS snippet,
         CASE WHEN doc_id % 17 = 0 THEN NULL ELSE 'Usuário ' || source END AS title,
         source AS app,
         CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'pf' ELSE 'pj' END AS segmento,
         doc_id
  FROM bronze_src
)"""


BRONZE, BRONZE_EVERY = bronze_cte(NEW_SIDE), bronze_cte(EVERY)

LAYOUT = """
layout AS (
  SELECT b.*,
         CASE doc_id % 3 WHEN 0 THEN 'my_app' WHEN 1 THEN 'appone' ELSE 'apptwo' END AS lapp,
         CASE WHEN doc_id % 2 = 0 THEN 'pf' ELSE 'pj' END AS lseg
  FROM bronze b
),
raw_read AS (
  SELECT avatar, date, id, iso_date, likes, rating, snippet, title,
         lapp || '_' || lseg AS app,
         CASE WHEN lapp = 'my_app' THEN '' ELSE lseg END AS segmento,
         lseg
  FROM layout
)"""


def norm_cte(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT avatar, id, iso_date, app, segmento,
         CAST(CAST(trunc(rating) AS INTEGER) AS VARCHAR) AS rating,
         likes, {fold('title')} AS title, {fold('snippet')} AS snippet
  FROM {src}
)"""


NORM = norm_cte("norm", "bronze")
NORM_L = norm_cte("norm_l", "raw_read")


def hist_cte(which: str) -> str:
    return f"""
hist AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         source AS app,
         CASE WHEN doc_id % 2 = 0 THEN 'pf' ELSE 'pj' END AS segmento,
         CAST(1 + (doc_id + CASE WHEN doc_id % 5 = v THEN 1 ELSE 0 END) % 5 AS VARCHAR) AS rating,
         '2024-02-' || {DAY} || CASE WHEN doc_id % 11 = v THEN 'T06:00:00Z' ELSE 'T00:00:00Z' END AS iso_date,
         CASE WHEN doc_id % 3 = v THEN 'OLD ' ELSE '' END || {fold("'Usuário ' || source")} AS title,
         CASE WHEN doc_id % 19 = v THEN 'X ' ELSE '' END || {fold('text')} AS snippet,
         '2024010' || CAST(v AS VARCHAR) AS odate
  FROM documents, (VALUES (1), (2)) t(v)
  WHERE {which}
)"""


HIST, HIST_EVERY = hist_cte(OLD_SIDE), hist_cte(EVERY)

NEW_ORDER = ("iso_date DESC NULLS LAST, title DESC NULLS LAST, snippet DESC NULLS LAST, "
             "rating DESC NULLS LAST, app DESC NULLS LAST, segmento DESC NULLS LAST, "
             "avatar DESC NULLS LAST, likes DESC NULLS LAST")
OLD_ORDER = ("odate_n DESC, iso_date DESC NULLS LAST, title DESC NULLS LAST, snippet DESC NULLS LAST, "
             "rating DESC NULLS LAST, app DESC NULLS LAST")
CHANGED = ("(n.title <> v.title OR n.snippet <> v.snippet OR n.rating <> v.rating "
           "OR n.iso_date <> v.iso_date)")
ENTRY = "concat_ws('|', v.title, v.snippet, v.app, coalesce(n.segmento, '~'), v.rating, v.iso_date)"
ENTRY_ORDER = "v.iso_date, v.title, v.snippet, v.rating, v.app"

VALID_COLS = "id, app, segmento, rating, iso_date, title, snippet, n_hist, history"
INVALID_COLS = "id, rating, app, iso_date, title, segmento, snippet"
VALID_PRED = ("id IS NOT NULL AND rating IS NOT NULL AND app IS NOT NULL AND iso_date IS NOT NULL "
              "AND title IS NOT NULL AND segmento IS NOT NULL AND snippet IS NOT NULL")
INVALID_PRED = ("(id IS NULL OR rating IS NULL OR app IS NULL OR iso_date IS NULL OR title IS NULL "
                "OR snippet IS NULL OR (in_batch AND segmento IS NULL))")


def merge_ctes(src: str = "norm", s: str = "", hist: str = "hist", run_date: str = RUN_DATE) -> str:
    """new1, ver, old1, ent, merged, checked, valid, invalid (suffix ``s``)."""
    return f"""
new1{s} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {NEW_ORDER}) AS rn,
           count(*) OVER (PARTITION BY id) AS n_batch
    FROM {src} WHERE id IS NOT NULL) WHERE rn = 1
),
ver{s} AS (
  SELECT id, iso_date, title, snippet, rating, app, max(CAST(odate AS INTEGER)) AS odate_n
  FROM {hist} WHERE odate < '{run_date}' AND id IS NOT NULL
  GROUP BY id, iso_date, title, snippet, rating, app
),
old1{s} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {OLD_ORDER}) AS rn FROM ver{s}) WHERE rn = 1
),
ent{s} AS (
  SELECT v.id, count(*) AS n_hist,
         string_agg({ENTRY}, ';' ORDER BY {ENTRY_ORDER}) AS history
  FROM ver{s} v JOIN new1{s} n ON n.id = v.id
  WHERE {CHANGED}
  GROUP BY v.id
),
merged{s} AS (
  SELECT coalesce(n.id, o.id) AS id,
         n.avatar,
         coalesce(n.app, o.app) AS app,
         n.segmento,
         coalesce(n.rating, o.rating) AS rating,
         coalesce(n.iso_date, o.iso_date) AS iso_date,
         coalesce(n.title, o.title) AS title,
         coalesce(n.snippet, o.snippet) AS snippet,
         n.likes,
         CAST(coalesce(e.n_hist, 0) AS BIGINT) AS n_hist,
         coalesce(e.history, '') AS history,
         n.id IS NOT NULL AS in_batch,
         CAST(coalesce(n.n_batch, 0) AS BIGINT) AS n_batch
  FROM new1{s} n FULL OUTER JOIN old1{s} o ON n.id = o.id
  LEFT JOIN ent{s} e ON e.id = coalesce(n.id, o.id)
),
checked{s} AS (
  SELECT * FROM merged{s}
  UNION ALL
  SELECT id, avatar, app, segmento, rating, iso_date, title, snippet, likes,
         CAST(0 AS BIGINT), '', true, CAST(1 AS BIGINT)
  FROM {src} WHERE id IS NULL
),
valid{s} AS (SELECT {VALID_COLS} FROM checked{s} WHERE {VALID_PRED}),
invalid{s} AS (
  SELECT {INVALID_COLS} FROM checked{s}
  WHERE {INVALID_PRED} AND (id IS NULL OR id NOT IN (SELECT id FROM {src} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))
  UNION ALL
  SELECT {INVALID_COLS} FROM (SELECT *, count(*) OVER (PARTITION BY id) AS copies FROM {src} WHERE id IS NOT NULL) WHERE copies > 1
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (BRONZE, NORM, HIST, merge_ctes())
LAYOUT_BASE = (BRONZE, LAYOUT, NORM_L, HIST, merge_ctes("norm_l", "_l"))
NEXT_DAY = "20240104"
HIST4 = """
hist4 AS (
  SELECT id, app, segmento, rating, iso_date, title, snippet, odate FROM hist
  UNION ALL
  SELECT id, app, segmento, rating, iso_date, title, snippet, '20240103' AS odate FROM valid_l
)"""
NEXT_DAY_BASE = LAYOUT_BASE + (HIST4, merge_ctes("norm_l", "_d4", "hist4", NEXT_DAY))

#: Every third document's versions under the id 1.
HOT = """
hist_hot AS (
  SELECT CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN '1' ELSE id END AS id, app, segmento, rating, iso_date,
         CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN title || ' ' || id ELSE title END AS title, snippet, odate FROM hist
)"""

#: Ten days of reviews (every document), and the set of versions of every id on every day.
TEN_DAYS = """
ten AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 13 = 0 AND k IN (4, 5) THEN 'X ' || source ELSE source END AS app,
         CAST(1 + ((doc_id + k) // 7) % 5 AS VARCHAR) AS rating,
         CASE WHEN dup = 1 THEN '2024-02-01T12:00:00Z' ELSE '2024-02-01T00:00:00Z' END AS iso_date,
         source AS title, text AS snippet, 20240200 + k AS day
  FROM documents, (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS k), (VALUES (0), (1)) t(dup)
  WHERE (doc_id + k) % 17 <> 0 AND (dup = 0 OR (doc_id % 29 = 4 AND k % 2 = 0))
),
sets AS (
  SELECT g.id, g.day, s.versions FROM (SELECT DISTINCT t.id, CAST(20240201 + r.i AS INTEGER) AS day FROM ten t, range(10) r(i)) g
  LEFT JOIN (SELECT id, day, list_sort(list(DISTINCT concat_ws('|', iso_date, title, snippet, rating, app))) AS versions FROM ten GROUP BY id, day) s
  ON s.id = g.id AND s.day = g.day
),
changes AS (SELECT *, lag(versions) OVER (PARTITION BY id ORDER BY day) AS before FROM sets)"""


def as_of(day: int) -> str:
    return (f"SELECT id, iso_date, title, snippet, rating, app, CAST(max(day) AS INTEGER) AS odate_n, '{day}' AS as_of "
            f"FROM ten WHERE day < {day} GROUP BY id, iso_date, title, snippet, rating, app")


PATHS = """
paths AS (
  SELECT doc_id,
         '/x/googlePlay/' || CASE WHEN doc_id % 3 = 0 THEN 'my_app' ELSE source END
         || CASE WHEN doc_id % 2 = 0 THEN '_pf' ELSE '_pj' END
         || CASE WHEN doc_id % 5 = 0 THEN '/dt=1' ELSE '/odate=20240101/p' END AS path
  FROM documents
)"""

APP_RE = "'/googlePlay/(.*?)/odate='"
SEG_RE = "'/googlePlay/[^/_]+_([pfj]+)/odate='"

NULL_COLS = ["id", "rating", "app", "iso_date", "title", "snippet"]


def null_msg(prefix: str = "null_") -> str:
    parts = ", ".join(f"CASE WHEN {prefix}{c} > 0 THEN '''{c}'': ' || CAST({prefix}{c} AS VARCHAR) END"
                      for c in NULL_COLS)
    return f"'Valores nulos encontrados nas colunas: {{' || concat_ws(', ', {parts}) || '}}.'"


NULL_AGGS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in NULL_COLS)
INT_OF = "TRY_CAST(TRY_CAST({x} AS DOUBLE) AS INTEGER)"

SUMMARY = f"""
agg AS (
  SELECT count(*) AS total_records,
         count(*) FILTER (WHERE NOT in_batch) AS history_only,
         count(*) FILTER (WHERE id IS NOT NULL AND n_batch > 1) AS duplicate_keys,
         coalesce(sum(n_batch) FILTER (WHERE id IS NOT NULL AND n_batch > 1), 0) AS duplicate_rows,
         {NULL_AGGS},
         count(*) FILTER (WHERE {INT_OF.format(x='rating')} IS NULL) AS invalid_ratings,
         count(*) FILTER (WHERE {VALID_PRED}) AS valid_count,
         count(*) FILTER (WHERE {INVALID_PRED} AND n_batch <= 1) AS invalid_rows,
         (SELECT count(*) FROM norm) AS batch_rows,
         string_agg(DISTINCT coalesce(segmento, 'UNKNOWN'), ',' ORDER BY coalesce(segmento, 'UNKNOWN'))
           FILTER (WHERE {VALID_PRED}) AS seglist
  FROM checked
),
summary AS (
  SELECT total_records, history_only, batch_rows, duplicate_keys, CAST(duplicate_rows AS BIGINT) AS duplicate_rows,
         {", ".join(f"null_{c}" for c in NULL_COLS)}, invalid_ratings,
         valid_count, invalid_rows + duplicate_rows AS invalid_count,
         valid_count + invalid_rows + duplicate_rows AS written_total,
         CASE WHEN batch_rows > 0 THEN valid_count / batch_rows * 100 ELSE 0.0 END AS pct_valid,
         CASE WHEN batch_rows > 0 THEN (invalid_rows + duplicate_rows) / batch_rows * 100 ELSE 0.0 END AS pct_invalid,
         duplicate_keys = 0 AS duplicate_status,
         ({" + ".join(f"null_{c}" for c in NULL_COLS)}) = 0 AS null_status,
         invalid_ratings = 0 AS type_status,
         CAST((duplicate_keys = 0)::INT + ((({" + ".join(f"null_{c}" for c in NULL_COLS)}) = 0))::INT
              + (invalid_ratings = 0)::INT AS INTEGER) AS success_count,
         CASE WHEN valid_count = 0 THEN 'NA' ELSE upper(seglist) END AS type_client
  FROM agg
),
summary2 AS (SELECT *, CAST(3 - success_count AS INTEGER) AS error_count FROM summary)"""

DUP_MSG = ("CASE WHEN duplicate_keys = 0 THEN 'Nenhum registro duplicado encontrado.' "
           "ELSE 'Registros duplicados encontrados: ' || CAST(duplicate_keys AS VARCHAR) "
           "|| ' registros com base no ''id''.' END")
NULL_MSG = f"CASE WHEN null_status THEN 'Nenhum valor nulo encontrado nas colunas criticas.' ELSE {null_msg()} END"
TYPE_MSG = ("CASE WHEN type_status THEN 'Consistencia dos tipos de dados verificada com sucesso.' "
            "ELSE 'Valores não numericos encontrados na coluna ''rating''.' END")


def code(status: str, bad: int) -> str:
    return f"CASE WHEN {status} THEN 200 ELSE {bad} END"


KV = rf"""
lines AS (
  SELECT doc_id, line, line_no
  FROM (SELECT doc_id, string_split(regexp_replace(text, {STRIP}, '', 'g'), chr(10)) AS arr FROM documents),
       LATERAL (SELECT unnest(arr) AS line, generate_subscripts(arr, 1) AS line_no)
),
parsed AS (
  SELECT doc_id, line_no,
         regexp_split_to_array(regexp_replace(line, {STRIP}, '', 'g'), ' => | = ') AS parts
  FROM lines
  WHERE length(regexp_replace(line, {STRIP}, '', 'g')) > 0 AND NOT starts_with(line, 'Scheduling mode')
),
kv AS (
  SELECT doc_id, line_no,
         regexp_replace(parts[1], {STRIP}, '', 'g') AS key,
         regexp_replace(parts[2], {STRIP}, '', 'g') AS value
  FROM parsed WHERE len(parts) = 2
)"""


#: Versions of a full scan of the history before 20240103.
STORE = ("SELECT id, iso_date, title, snippet, rating, {app} AS app, max(CAST(odate AS INTEGER)) AS odate_n "
         "FROM hist GROUP BY ALL")
#: What each class of endings folds to, by ``doc_id`` (the endings stand in ``tessera.registry``).
WIDE_ENDINGS = [
    ("ordinals", "1O LUGAR, 2A VEZ"), ("fractions and signs", "1/2 2 TM (C)"), ("emoji", "OTIMO !"), ("full width", "ABC12"),
    ("Cyrillic", "KHOROSHO, SPASIBO"), ("Greek", "ELLADA"), ("Devanagari", "हिन्दी"), ("Thai", "ภาษาไทยดี"),
    ("combining marks", "ETE N"), ("ligature and quotes", 'FIM DE "ASPAS" - JA...'), ("degree and currency", "25DEG +/-1 EUR5"), ("ASCII", "PLAIN"),
]


def all_sql() -> dict[str, str]:
    b = with_ctes(*BASE)
    lb = with_ctes(*LAYOUT_BASE)
    raw_cols = "avatar, date, id, iso_date, likes, rating, snippet, title, app, segmento"
    join_cols = ("coalesce(n.id, v.id) AS id, n.iso_date AS new_iso_date, n.title AS new_title, "
                 "n.snippet AS new_snippet, n.rating AS new_rating, n.app AS new_app, "
                 "n.segmento AS new_segmento, n.avatar AS new_avatar, n.likes AS new_likes, "
                 "v.iso_date AS old_iso_date, v.title AS old_title, v.snippet AS old_snippet, "
                 "v.rating AS old_rating, v.app AS old_app, v.odate_n")
    left_join = f"{b}SELECT {join_cols} FROM new1 n LEFT JOIN ver v ON n.id = v.id"
    return {
        # sources
        "bronze_scan": with_ctes(BRONZE_EVERY, LAYOUT) + f"SELECT {raw_cols} FROM raw_read",
        "drifting_scan": with_ctes(BRONZE_EVERY, LAYOUT) + (
            "SELECT * REPLACE (CASE WHEN app LIKE 'apptwo%' THEN trunc(rating) ELSE rating END AS rating, CASE WHEN app NOT LIKE 'apptwo%' THEN likes END AS likes), "
            f"2 AS n_unreadable, 'appone_pf,my_app_pf' AS unreadable_apps FROM (SELECT {raw_cols} FROM raw_read)"),
        "segment_union": with_ctes(BRONZE_EVERY, LAYOUT) + f"SELECT {raw_cols} FROM raw_read",
        "path_app_extract": with_ctes(PATHS) + f"SELECT doc_id, path, regexp_extract(path, {APP_RE}, 1) AS app FROM paths",
        "path_segment_extract": with_ctes(PATHS)
        + f"SELECT doc_id, path, regexp_extract(path, {SEG_RE}, 1) AS segmento FROM paths",
        "history_scan": with_ctes(HIST_EVERY)
        + f"SELECT id, app, segmento, rating, iso_date, title, snippet, odate FROM hist WHERE odate < '{RUN_DATE}'",
        "store_first_day": with_ctes(HIST_EVERY) + (
            "SELECT id, iso_date, title, snippet, rating, app, max(CAST(odate AS INTEGER)) AS odate_n, as_of "
            "FROM hist JOIN (VALUES ('20240101'), ('20240102'), ('20240103')) a(as_of) ON odate < as_of "
            "GROUP BY id, iso_date, title, snippet, rating, app, as_of"),
        "store_late_partition": with_ctes(HIST_EVERY) + STORE.format(app="app"),
        "store_rewritten_day": with_ctes(HIST_EVERY) + STORE.format(app="CASE WHEN odate = '20240101' THEN 'fixed ' ELSE '' END || app"),
        "store_ten_days": with_ctes(TEN_DAYS) + as_of(20240206) + " UNION ALL " + as_of(20240211),
        "store_daily_writes": with_ctes(TEN_DAYS) + (
            "SELECT CAST(day AS INTEGER) AS day, n AS rows_written, n AS event_rows, gone AS gone_rows FROM ("
            "SELECT day, CAST(sum(CASE WHEN versions IS NOT DISTINCT FROM before THEN 0 WHEN versions IS NULL THEN 1 ELSE len(versions) END) AS BIGINT) AS n, "
            "count(*) FILTER (WHERE versions IS NULL AND before IS NOT NULL) AS gone FROM changes GROUP BY day)"),
        "history_compact": with_ctes(HIST_EVERY)
        + ("SELECT id, iso_date, title, snippet, rating, app, max(CAST(odate AS INTEGER)) AS odate_n "
           f"FROM hist WHERE odate < '{RUN_DATE}' GROUP BY id, iso_date, title, snippet, rating, app"),
        "merge_no_history": with_ctes(BRONZE_EVERY, NORM, HIST, merge_ctes())
        + "SELECT id, avatar, app, segmento, rating, iso_date, title, snippet, likes, CAST(0 AS BIGINT) AS n_hist, "
          "'' AS history, true AS in_batch, CAST(n_batch AS BIGINT) AS n_batch FROM new1",
        # projections
        "accent_fold": f"SELECT doc_id, {fold('text')} AS folded FROM documents",
        "accent_fold_wide": (
            f"SELECT doc_id, {fold('text')} || ' ' || (["
            + ", ".join("'" + x.replace("'", "''") + "'" for _, x in WIDE_ENDINGS)
            + f"])[doc_id % {len(WIDE_ENDINGS)} + 1] AS folded FROM documents"),
        "rating_truncate": with_ctes(BRONZE_EVERY)
        + "SELECT doc_id, id, iso_date, rating AS rating_in, "
          "CAST(CAST(trunc(rating) AS INTEGER) AS VARCHAR) AS rating FROM bronze",
        "normalize_reviews": with_ctes(BRONZE_EVERY, NORM) + "SELECT * FROM norm",
        "schema_conform": b + (
            "SELECT id, CAST(length(app) + 0.5::DOUBLE AS VARCHAR) AS app, segmento, rating, iso_date, title, snippet, n_hist, history, "
            "'string' AS id_type, 'string' AS rating_type, 'string' AS app_type FROM checked"),
        "sample_preview": b + f"SELECT {VALID_COLS} FROM valid ORDER BY id LIMIT 10",
        # joins / merge
        "history_full_outer": f"{b}SELECT {join_cols} FROM new1 n FULL OUTER JOIN ver v ON n.id = v.id",
        "history_left_outer": left_join,
        "salted_history_join": left_join,
        "salted_hot_id": with_ctes(BRONZE_EVERY, NORM, HIST_EVERY, HOT, merge_ctes(hist="hist_hot")) + f"SELECT {join_cols} FROM new1 n LEFT JOIN ver v ON n.id = v.id",
        "heavy_hitters": with_ctes(HIST_EVERY, HOT) + (
            "SELECT id, true AS salted FROM (SELECT DISTINCT id, iso_date, title, snippet, rating, app FROM hist_hot WHERE odate < '" + RUN_DATE + "') GROUP BY id HAVING count(*) > 20"),
        "change_detection": b + (
            "SELECT v.id, v.iso_date, v.title, v.snippet, v.rating, v.app, n.segmento AS new_segmento, "
            "coalesce(n.title <> v.title, false) AS title_changed, "
            "coalesce(n.snippet <> v.snippet, false) AS snippet_changed, "
            "coalesce(n.rating <> v.rating, false) AS rating_changed, "
            "coalesce(n.iso_date <> v.iso_date, false) AS iso_date_changed, "
            f"coalesce({CHANGED}, false) AS changed "
            "FROM ver v JOIN new1 n ON n.id = v.id"),
        "snapshot_merge": b + "SELECT * FROM merged",
        "history_left_filtered": b + "SELECT * FROM merged WHERE in_batch",
        "history_collect": b + "SELECT id, n_hist, history FROM ent",
        "history_explode": b + ("SELECT v.id, v.title, v.snippet, v.app, n.segmento, v.rating, v.iso_date "
                                f"FROM ver v JOIN new1 n ON n.id = v.id WHERE {CHANGED}"),
        "history_regroup": b + (
            "SELECT v.id, v.app, v.segmento, v.rating, v.iso_date, v.title, v.snippet, "
            "CAST(coalesce(t.n, 0) AS BIGINT) AS n_hist, coalesce(t.history, '') AS history FROM valid v LEFT JOIN ("
            f"SELECT v.id, count(*) AS n, string_agg({ENTRY}, ';' ORDER BY {ENTRY_ORDER}) AS history "
            f"FROM ver v JOIN new1 n ON n.id = v.id, (VALUES (1), (2)) c(copy) WHERE {CHANGED} GROUP BY v.id) t ON t.id = v.id"),
        "history_empty_normalise": b + (
            "SELECT id, CASE WHEN CAST(id AS BIGINT) % 2 <> 0 THEN n_hist ELSE 0 END AS n_hist, "
            "CASE WHEN CAST(id AS BIGINT) % 2 <> 0 THEN history ELSE '' END AS history, true AS has_array FROM merged"),
        # checks
        "duplicate_keys": with_ctes(BRONZE_EVERY, NORM)
        + "SELECT id, count(*) AS n FROM norm WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
        "duplicate_rows": with_ctes(BRONZE_EVERY, NORM)
        + ("SELECT * FROM norm WHERE id IN "
           "(SELECT id FROM norm WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"),
        "duplicate_check": with_ctes(BRONZE_EVERY, NORM) + (
            "SELECT 'duplicate_check' AS \"check\", duplicate_keys = 0 AS status, "
            f"{code('duplicate_keys = 0', 409)} AS code, {DUP_MSG} AS message, duplicate_keys AS n_failed "
            "FROM (SELECT count(*) AS duplicate_keys FROM "
            "(SELECT id FROM norm WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))"),
        "null_counts": with_ctes(BRONZE_EVERY, NORM) + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM norm"
            for c in NULL_COLS),
        "null_check": b + (
            "SELECT 'null_check' AS \"check\", n_failed = 0 AS status, "
            f"{code('n_failed = 0', 400)} AS code, "
            f"CASE WHEN n_failed = 0 THEN 'Nenhum valor nulo encontrado nas colunas criticas.' "
            f"ELSE {null_msg()} END AS message, n_failed, "
            + ", ".join(f"null_{c}" for c in NULL_COLS)
            + " FROM (SELECT *, CAST(" + " + ".join(f"(null_{c} > 0)::INT" for c in NULL_COLS)
            + f" AS BIGINT) AS n_failed FROM (SELECT {NULL_AGGS} FROM checked))"),
        "type_check": (
            "SELECT 'type_consistency_check' AS \"check\", n_failed = 0 AS status, "
            f"{code('n_failed = 0', 400)} AS code, "
            "CASE WHEN n_failed = 0 THEN 'Consistencia dos tipos de dados verificada com sucesso.' "
            "ELSE 'Valores não numericos encontrados na coluna ''rating''.' END AS message, "
            "n_null, n_malformed, n_failed FROM (SELECT *, n_null + n_malformed AS n_failed FROM ("
            "SELECT count(*) FILTER (WHERE rating_raw IS NULL) AS n_null, "
            f"count(*) FILTER (WHERE rating_raw IS NOT NULL AND {INT_OF.format(x='rating_raw')} IS NULL) "
            "AS n_malformed FROM (SELECT CASE WHEN doc_id % 31 = 0 THEN 'n/a' WHEN doc_id % 23 = 0 THEN NULL "
            "ELSE CAST(1 + doc_id % 5 AS VARCHAR) || '.75' END AS rating_raw FROM documents)))"),
        "split_valid": b + "SELECT * FROM valid",
        "split_invalid": b + "SELECT * FROM invalid",
        "quality_summary": with_ctes(*BASE, SUMMARY) + "SELECT * FROM summary2",
        "validation_results": with_ctes(*BASE, SUMMARY) + (
            "SELECT 'duplicate_check' AS \"check\", duplicate_status AS status, "
            f"{code('duplicate_status', 409)} AS code, {DUP_MSG} AS message, "
            "CASE WHEN duplicate_status THEN 'PASSOU' ELSE 'FALHOU' END AS report FROM summary2 UNION ALL "
            "SELECT 'null_check', null_status, " + code('null_status', 400) + f", {NULL_MSG}, "
            "CASE WHEN null_status THEN 'PASSOU' ELSE 'FALHOU' END FROM summary2 UNION ALL "
            "SELECT 'type_consistency_check', type_status, " + code('type_status', 400) + f", {TYPE_MSG}, "
            "CASE WHEN type_status THEN 'PASSOU' ELSE 'FALHOU' END FROM summary2"),
        "segment_list": with_ctes(*BASE, SUMMARY) + "SELECT type_client FROM summary2",
        "table_size_profile": with_ctes(HIST_EVERY) + (
            "SELECT odate, segmento, count(*) AS \"rows\", CAST(sum("
            + " + ".join(f"coalesce(strlen({c}), 0)" for c in ["id", "app", "rating", "iso_date", "title", "snippet"])
            + ") AS BIGINT) AS text_bytes FROM hist GROUP BY odate, segmento"),
        # sinks / job / documents
        "silver_roundtrip": lb + (
            "SELECT id, app, segmento, rating, iso_date, title, snippet, CAST(0 AS BIGINT) AS n_hist, "
            "'' AS history, odate FROM hist UNION ALL "
            f"SELECT {VALID_COLS}, '{RUN_DATE}' AS odate FROM valid_l"),
        "quarantine_roundtrip": lb + f"SELECT {INVALID_COLS}, '{RUN_DATE}' AS odate FROM invalid_l",
        "rerun_empty_quarantine": b + (
            f"SELECT {INVALID_COLS}, '20240102' AS odate, CAST((SELECT count(*) FROM invalid) AS INTEGER) AS rows_kept, 0 AS rows_again FROM invalid"),
        "publish_failed_write": with_ctes(HIST_EVERY) + (
            "SELECT id, app, segmento, rating, iso_date, title, snippet, CAST(0 AS BIGINT) AS n_hist, '' AS history, odate, true AS write_failed FROM hist"),
        "publish_over_plain": with_ctes(HIST_EVERY) + (
            "SELECT id, CASE WHEN odate = '20240102' THEN 'fixed ' ELSE '' END || app AS app, segmento, rating, iso_date, title, snippet, odate FROM hist"),
        "job_valid": lb + "SELECT * FROM valid_l",
        "silver_next_day": with_ctes(*NEXT_DAY_BASE) + "SELECT * FROM valid_d4",
        "job_invalid": lb + "SELECT * FROM invalid_l",
        "run_metrics_doc": with_ctes(*BASE, SUMMARY) + (
            "SELECT valid_count, pct_valid AS valid_pct, invalid_count, pct_invalid AS invalid_pct, "
            "written_total AS total_records, total_records AS checked_records, success_count, error_count, "
            "type_client, "
            f"duplicate_status AS duplicate_check_status, {code('duplicate_status', 409)} AS duplicate_check_code, "
            f"{DUP_MSG} AS duplicate_check_message, "
            f"null_status AS null_check_status, {code('null_status', 400)} AS null_check_code, "
            f"{NULL_MSG} AS null_check_message, "
            f"type_status AS type_consistency_check_status, {code('type_status', 400)} AS type_consistency_check_code, "
            f"{TYPE_MSG} AS type_consistency_check_message, "
            "'silver_reviews' AS source_app, '1.50 min' AS total_processing_time FROM summary2, (VALUES (1), (2)) written(n)"),
        "run_documents_current": with_ctes(*LAYOUT_BASE) + (
            f"SELECT 'done' AS kind, '{RUN_DATE}' AS run_date, CAST(3 AS BIGINT) AS attempt, (SELECT count(*) FROM valid_l) AS valid_count, "
            "(SELECT count(*) FROM invalid_l) AS invalid_count, (SELECT string_agg(s, ',' ORDER BY s) FROM ("
            "SELECT DISTINCT upper(coalesce(segmento, 'UNKNOWN')) AS s FROM valid_l)) AS type_client, NULL AS error UNION ALL "
            "SELECT 'failed', '20240102', 2, NULL, NULL, NULL, 'unsupported join type ' || chr(39) || 'sideways' || chr(39)"),
        "failure_doc": with_ctes(BRONZE_EVERY, NORM) + (
            "SELECT 'silver' AS layer, 'reviews' AS project, 'app_reviews_silver' AS job, '0' AS priority, "
            "'data-platform' AS tower, client, 'bronze scan failed: no segment folder' AS error FROM ("
            "SELECT string_agg(coalesce(segmento, 'none'), ',' ORDER BY segmento NULLS LAST) AS client "
            "FROM (SELECT DISTINCT segmento FROM norm) UNION ALL SELECT 'UNKNOWN_CLIENT')"),
        "kv_report_parse": with_ctes(KV)
        + "SELECT doc_id, key, arg_max(value, line_no) AS value FROM kv GROUP BY doc_id, key",
    }
