"""The registered queries in SQL, for checking results with another engine."""

from __future__ import annotations

from attrspark.functions.names import SHARD_IMAGE_SUFFIXES, STREAM_IMAGE_SUFFIXES
from attrspark.functions.tags import DATASET_RULES, SHARD_RULES, TagRules
from attrspark.operators.lexical import HEAD_NOUNS, option_pattern
from attrspark.plans.inputs import DOCS_PER_SHARD
from attrspark.vocabulary import ATTRIBUTE_OPTIONS, IMAGE_VOCABULARY, TEXT_ATTRIBUTE_OPTIONS

NAMES = IMAGE_VOCABULARY.names


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values_list(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def columns(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in NAMES)


def pick(attribute: str, index: str) -> str:
    return f"{values_list(ATTRIBUTE_OPTIONS[attribute])}[CAST({index} AS INT) + 1]"


def suffix_list(suffixes) -> str:
    return "(" + ", ".join(quoted(s) for s in suffixes) + ")"


# Inputs

VOCABULARY = "vocab(attribute, attr_idx, option, opt_idx, ordinal, prompt) AS (VALUES {})".format(
    ", ".join(
        f"({quoted(a)}, {i}, {quoted(o)}, {j}, {n}, {quoted(p)})"
        for a, i, o, j, n, p in IMAGE_VOCABULARY.rows()
    )
)

SCORES = f"""{VOCABULARY},
lab AS (
  SELECT v.*, CAST(e.embedding AS DOUBLE[]) AS lv FROM vocab v JOIN embeddings e ON e.vec_id = v.ordinal
),
scores AS (
  SELECT e.vec_id, l.attribute, l.option, l.opt_idx, l.prompt,
         5.0::DOUBLE * list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), l.lv) AS score
  FROM embeddings e CROSS JOIN lab l
)"""


def winners(scores: str, key: str) -> str:
    """CTEs probs, best and wide (one column per attribute) over a score CTE."""
    pivots = ",\n         ".join(
        f"max(CASE WHEN attribute = {quoted(n)} AND probability > 0.3 THEN option END) AS {n}"
        for n in NAMES
    )
    return f"""peak AS (
  SELECT {key}, attribute, max(score) AS top FROM {scores} GROUP BY {key}, attribute
),
mass AS (
  SELECT s.{key}, s.attribute, sum(exp(s.score - p.top)) AS total
  FROM {scores} s JOIN peak p ON p.{key} = s.{key} AND p.attribute = s.attribute
  GROUP BY s.{key}, s.attribute
),
probs AS (
  SELECT s.{key}, s.attribute, s.option, s.opt_idx, s.score, exp(s.score - p.top) / m.total AS probability
  FROM {scores} s JOIN peak p ON p.{key} = s.{key} AND p.attribute = s.attribute
  JOIN mass m ON m.{key} = s.{key} AND m.attribute = s.attribute
),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {key}, attribute ORDER BY probability DESC, opt_idx) AS rn
    FROM probs
  ) WHERE rn = 1
),
wide AS (
  SELECT {key},
         {pivots}
  FROM best GROUP BY {key}
)"""


ZERO_SHOT = f"{SCORES},\n{winners('scores', 'vec_id')}"

RESULTS = f"""{ZERO_SHOT},
res AS (
  SELECT vec_id, {", ".join(f"CASE WHEN vec_id % 19 = 0 OR vec_id % 23 = 0 THEN NULL ELSE {n} END AS {n}" for n in NAMES)},
         CASE WHEN vec_id % 19 = 0 THEN 'boom' END AS error, vec_id % 3 = 0 AS hit
  FROM wide
)"""

CAPTIONS = f"""f1a AS (
  SELECT c_custkey AS k, {pick('Hair_Color', 'c_custkey % 7')} AS color, {pick('Eye_Color', 'c_custkey % 5')} AS eye,
         {pick('Age', 'c_custkey % 5')} AS age, {pick('Gender', 'c_custkey % 3')} AS gender,
         {pick('Hair_Length', 'c_custkey % 4')} AS len
  FROM customer
),
f1b AS (
  SELECT *, list_filter([
      CASE WHEN k % 2 = 0 THEN '1girl' ELSE '1boy' END, color || ' hair', CASE WHEN k % 7 = 0 THEN '' END,
      eye || ' eyes',
      ['school uniform', 'cowboy hat', 'red jacket', 'cat ears', 'Hero_(character)'][CAST(k % 5 AS INT) + 1],
      CASE WHEN k % 6 = 0 THEN 'main character' END], lambda t: t IS NOT NULL) AS tags
  FROM f1a
),
f1 AS (
  SELECT k AS c_custkey,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN '   '
         ELSE 'a ' || age || ' ' || gender || ' with ' || len || ' ' || color || ' hair and ' || eye || ' eyes' END AS caption,
    CASE WHEN k % 17 = 0 THEN ''
         WHEN k % 3 = 0 THEN array_to_string(list_transform(tags, lambda t: replace(t, ' ', '_')), ' ')
         ELSE array_to_string(tags, ', ') END AS tag_string_general,
    CASE WHEN k % 4 = 0 THEN NULL WHEN k % 19 = 0 THEN CAST([] AS VARCHAR[]) ELSE tags END AS general
  FROM f1b
)"""

MEMBERS = """f2a AS (
  SELECT doc_id AS d, text, 'shard/item_' || doc_id || '_' || md5(CAST(doc_id AS VARCHAR)) AS base,
         CASE WHEN doc_id % 11 = 0 THEN 'bad:' ELSE 'img:' END || md5(CAST(doc_id AS VARCHAR)) AS marker
  FROM documents
),
f2b AS (
  SELECT d AS doc_id, d * 2 AS pos, base || CASE WHEN d % 3 = 0 THEN '.JPG' ELSE '.jpg' END AS name, marker AS payload
  FROM f2a WHERE d % 5 <> 0
  UNION ALL SELECT d, d * 2 + 1, base || '.txt', text FROM f2a WHERE d % 7 <> 0
  UNION ALL SELECT d, d + 1000000000, 'note_' || d || '.txt', text FROM f2a WHERE d % 50 = 0
  UNION ALL SELECT d, d + 2000000000, 'shard/item_' || d || '.jpg', marker FROM f2a WHERE d % 50 = 1
  UNION ALL SELECT d, d + 3000000000, 'shard/item_' || d || '_second.jpg', marker FROM f2a WHERE d % 50 = 2
),
f2c AS (
  SELECT *, strlen(payload) AS size, split_part(name, '/', -1) AS file FROM f2b
),
f2 AS (
  SELECT *, '.' || lower(split_part(file, '.', -1)) AS suffix,
         substr(file, 1, length(file) - length(split_part(file, '.', -1)) - 1) AS stem,
         nullif(regexp_extract(file, '^(item_[^_]*)', 1), '') AS id
  FROM f2c
)"""

KIND = (
    f"CASE WHEN suffix IN {suffix_list(SHARD_IMAGE_SUFFIXES)} THEN 'image' "
    "WHEN suffix = '.txt' THEN 'text' ELSE 'other' END"
)

PAIRS = f"""{MEMBERS},
pairs AS (
  SELECT id, arg_min(name, pos) FILTER (WHERE {KIND} = 'image') AS image,
         arg_min(payload, pos) FILTER (WHERE {KIND} = 'text') AS text
  FROM f2 WHERE id IS NOT NULL AND {KIND} <> 'other' GROUP BY id
)"""

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

STEM_PAIRS = f"""WITH {MEMBERS},
img AS (
  SELECT stem, arg_max(name, pos) AS image FROM f2
  WHERE suffix IN {suffix_list(STREAM_IMAGE_SUFFIXES)} GROUP BY stem
),
txt AS (
  SELECT stem, arg_max({STRIP.format('payload')}, pos) AS text FROM f2 WHERE suffix = '.txt' GROUP BY stem
)
SELECT img.stem, img.image, txt.text FROM img JOIN txt ON img.stem = txt.stem"""


def lexical(column: str, attribute: str) -> str:
    """The option a text mentions first, when it is likely enough."""
    options = TEXT_ATTRIBUTE_OPTIONS[attribute]
    hits = [
        f"(regexp_matches(lower({column}), {quoted(option_pattern(attribute, o))}))" for o in options
    ]
    n = len(options)
    k = " + ".join(f"CAST({h} AS INT)" for h in hits)
    cases = " ".join(f"WHEN {h} THEN {quoted(o)}" for h, o in zip(hits, options))
    sure = f"exp(5.0) / (({k}) * exp(5.0) + {n} - ({k})) > 0.3"
    return f"CASE WHEN {sure} THEN CASE {cases} END END"


def lexical_columns(column: str, when: str = "TRUE") -> str:
    return ", ".join(
        f"CASE WHEN {when} THEN {lexical(column, n)} END AS {n}"
        if n in TEXT_ATTRIBUTE_OPTIONS
        else f"CAST(NULL AS VARCHAR) AS {n}"
        for n in NAMES
    )


assert set(HEAD_NOUNS) <= set(TEXT_ATTRIBUTE_OPTIONS)

TRIMMED = "list_transform(string_split({}, ','), lambda t: trim(t))"
AUTO = (
    "list_filter(CASE WHEN contains({0}, ',') THEN list_transform(string_split({0}, ','), lambda t: trim(t)) "
    "ELSE string_split({0}, ' ') END, lambda t: t <> '')"
)


def group_case(tag: str, rules: TagRules) -> str:
    def has(words) -> str:
        return "(" + " OR ".join(f"contains(lower({tag}), {quoted(w)})" for w in words) + ")"

    return (
        f"CASE WHEN {has(rules.appearance)} THEN 'appearance_tags' WHEN {has(rules.clothing)} THEN 'clothing_tags' "
        f"WHEN {has(rules.character)} OR ends_with({tag}, {quoted(rules.character_suffix)}) THEN 'character_tags' "
        "ELSE 'other_tags' END"
    )


def grouped(tags: str, rules: TagRules) -> str:
    lists = ", ".join(
        f"coalesce(array_to_string(list_filter(t, lambda x: {group_case('x', rules)} = {quoted(g)}), '|'), '') AS {g}"
        for g in ("character_tags", "appearance_tags", "clothing_tags", "other_tags")
    )
    return f"""WITH {CAPTIONS}, tagged AS (SELECT c_custkey, {tags} AS t FROM f1)
SELECT c_custkey, {lists}, CAST(len(t) AS INT) AS tag_count FROM tagged"""


GENERAL = "list_filter(general, lambda t: t IS NOT NULL AND trim(t) <> '')"
TAG_SOURCE = (
    f"CASE WHEN len(general) > 0 THEN {GENERAL} "
    f"WHEN length(tag_string_general) > 0 THEN {AUTO.format('tag_string_general')} END"
)

DONE = "done AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels)"
ITEMS = "items AS (SELECT CAST(doc_id AS VARCHAR) AS id, * FROM documents)"

PRIOR = """f7 AS (
  SELECT conv_id, turn,
    CASE WHEN conv_id % 50 = 0 AND turn = 0 THEN '[1]' WHEN conv_id % 50 = 1 AND turn = 0 THEN '5'
         WHEN turn % 5 = 4 THEN '{bad'
         WHEN turn % 3 = 1 THEN '{"item_id":"' || conv_id || '-' || turn || '"}'
         ELSE '{"id":"' || conv_id || '-' || turn || '"}' END AS line
  FROM conversations
),
f7ids AS (
  SELECT conv_id, turn, coalesce(json_extract_string(line, '$.id'), json_extract_string(line, '$.item_id')) AS id
  FROM (SELECT * FROM f7 WHERE json_valid(line) AND starts_with(line, '{'))
)"""

LATEST = """upserted AS (
  SELECT * FROM (
    SELECT md5(CAST(user_id AS VARCHAR)) AS hash_key, props AS attributes, ts, event_id AS seq,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events
  ) WHERE rn = 1
)"""

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

# Marker scores: hex digit o mod 32 of the marker, divided by 3.
MARKERS = f"""{VOCABULARY},
markers AS (
  SELECT pos, id, payload FROM {{source}}
),
mscores AS (
  SELECT m.pos, v.attribute, v.option, v.opt_idx,
         (strpos('0123456789abcdef', substr(m.payload, 5 + CAST(v.ordinal % 32 AS INT), 1)) - 1) / 3.0::DOUBLE AS score
  FROM markers m CROSS JOIN vocab v WHERE starts_with(m.payload, 'img:')
),
{winners('mscores', 'pos')}"""

JSON_RECORD = " || ',' || ".join(
    f"""'"{n}":' || CASE WHEN {n} IS NULL THEN 'null' ELSE '"' || {n} || '"' END""" for n in NAMES
)
JSON_RECORD = f"'{{' || {JSON_RECORD} || '}}'"

PICTURES = f"""f10 AS (
  SELECT p_partkey AS k, 'pic_' || p_partkey AS id,
         ['.png', '.PNG', '.png', '.jpeg', '.txt'][CAST(p_partkey % 5 AS INT) + 1] AS ending,
         CAST(16 + p_partkey * 37 % 61 AS INT) AS width, CAST(16 + p_partkey * 53 % 61 AS INT) AS height,
         ['RGB', 'RGBA', 'L', 'junk'][p_size % 4 + 1] AS mode
  FROM part
)"""

ORACLES: dict[str, str] = {
    "zero_shot_attributes": f"WITH {ZERO_SHOT} SELECT vec_id, {columns()} FROM wide",
    "zero_shot_scores": f"WITH {SCORES} SELECT vec_id, attribute, option, round(score, 6) AS score FROM scores",
    "zero_shot_probs": f"""WITH {ZERO_SHOT}
SELECT vec_id, attribute, opt_idx, round(probability, 6) AS probability FROM probs""",
    "label_prompts": f"""WITH {ZERO_SHOT}
SELECT vec_id, attribute, 'a ' || option || ' person' AS prompt FROM best WHERE probability > 0.3""",
    "attributes_to_json": f"WITH {RESULTS} SELECT vec_id, {JSON_RECORD} AS json FROM res",
    "attributes_from_json": f"""WITH {RESULTS},
lines AS (
  SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN '{{"Gender":"x"}}'
    ELSE '{{"Unknown":"u",' || substr({JSON_RECORD}, 2) END AS line FROM res
)
SELECT vec_id, {", ".join(f"json_extract_string(line, '$.{n}') AS {n}" for n in NAMES)} FROM lines""",
    "is_empty": f"WITH {RESULTS} SELECT vec_id, coalesce({columns()}) IS NULL AS empty FROM res",
    "filled_attributes": f"WITH {RESULTS} "
    + " UNION ALL ".join(
        f"SELECT vec_id, {quoted(n)} AS attribute, {n} AS value FROM res WHERE {n} IS NOT NULL" for n in NAMES
    ),
    "result_status": f"""WITH {RESULTS}
SELECT vec_id, CASE WHEN error IS NOT NULL THEN 'error' WHEN coalesce({columns()}) IS NULL THEN 'empty'
  ELSE 'filled' END AS status FROM res""",
    "text_attributes": f"WITH {CAPTIONS} SELECT c_custkey, {lexical_columns('caption')} FROM f1",
    "member_kind": f"WITH {MEMBERS} SELECT pos, suffix, stem, {KIND} AS kind FROM f2",
    "member_ids": f"WITH {MEMBERS} SELECT pos, id FROM f2",
    "group_members": f"""WITH {MEMBERS}
SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS member_no, name,
       count(*) OVER (PARTITION BY id) AS n_members
FROM f2 WHERE id IS NOT NULL""",
    "pair_by_id": f"WITH {PAIRS} SELECT id, image, text FROM pairs",
    "pair_by_stem": STEM_PAIRS,
    "shard_stats": f"""WITH {MEMBERS}
SELECT count(*) AS total_files, count(*) FILTER (WHERE {KIND} = 'image') AS image_files,
       count(*) FILTER (WHERE {KIND} = 'text') AS text_files, count(DISTINCT id) AS unique_ids,
       round(CAST(sum(size) AS DOUBLE) / 1048576, 6) AS size_mb FROM f2""",
    "scan_tar_members": f"""WITH {MEMBERS}
SELECT 'shard-' || lpad(CAST(doc_id // {DOCS_PER_SHARD} AS VARCHAR), 6, '0') || '.tar' AS shard, name, size FROM f2""",
    "scan_dataset": "SELECT doc_id, lang, source, text, n_chars FROM documents",
    "validate_images": """WITH f8 AS (
  SELECT p_partkey, 16 + p_partkey * 37 % 1500 AS width, 16 + p_partkey * 53 % 1500 AS height,
         ['RGB', 'RGBA', 'L', 'P'][p_size % 4 + 1] AS mode FROM part
)
SELECT p_partkey, width >= 32 AND height >= 32 AND mode IN ('RGB', 'RGBA', 'L') AS valid, mode <> 'RGB' AS needs_rgb
FROM f8""",
    "resize_dims": """WITH f8 AS (
  SELECT p_partkey, 16 + p_partkey * 37 % 1500 AS w, 16 + p_partkey * 53 % 1500 AS h FROM part
),
r AS (
  SELECT p_partkey,
    CAST(CASE WHEN greatest(w, h) <= 512 THEN w WHEN w > h THEN 512 ELSE w * 512 // h END AS INT) AS width,
    CAST(CASE WHEN greatest(w, h) <= 512 THEN h WHEN w > h THEN h * 512 // w ELSE 512 END AS INT) AS height
  FROM f8
)
SELECT *, width < 1 OR height < 1 AS degenerate FROM r""",
    "scan_image_dir": f"""WITH {PICTURES}
SELECT id, CASE WHEN mode <> 'junk' THEN width END AS width, CASE WHEN mode <> 'junk' THEN height END AS height,
       CASE WHEN mode <> 'junk' THEN mode END AS mode, mode <> 'junk' AND width >= 32 AND height >= 32 AS valid,
       CASE WHEN mode = 'junk' THEN 'image_load_failed' END AS error
FROM f10 WHERE ending <> '.txt'""",
    "source_fallback": """SELECT doc_id,
  CASE WHEN doc_id % 3 = 0 THEN 'image' WHEN doc_id % 2 = 0 THEN 'text' ELSE 'caption' END AS source,
  CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN text ELSE 'caption ' || lang END AS text_input,
  CASE WHEN doc_id % 3 = 0 THEN upper(hex(md5(CAST(doc_id AS VARCHAR)))) END AS image_hex
FROM documents WHERE doc_id % 3 = 0 OR doc_id % 2 = 0 OR doc_id % 5 = 0""",
    "tag_source": f"""WITH {CAPTIONS}, tagged AS (SELECT c_custkey, {TAG_SOURCE} AS t FROM f1)
SELECT c_custkey, CASE WHEN t IS NOT NULL THEN coalesce(array_to_string(t, '|'), '') END AS tags,
       CAST(len(t) AS INT) AS n_tags FROM tagged""",
    "parse_tags_comma": f"""WITH {CAPTIONS}, tagged AS (SELECT c_custkey, {TRIMMED.format('tag_string_general')} AS t FROM f1)
SELECT c_custkey, coalesce(array_to_string(t, '|'), '') AS tags, CAST(len(t) AS INT) AS tag_count FROM tagged""",
    "parse_tags_auto": f"""WITH {CAPTIONS}, tagged AS (SELECT c_custkey, {AUTO.format('tag_string_general')} AS t FROM f1)
SELECT c_custkey, coalesce(array_to_string(t, '|'), '') AS tags, CAST(len(t) AS INT) AS tag_count FROM tagged""",
    "categorize_tags_a": grouped(TRIMMED.format("tag_string_general"), SHARD_RULES),
    "categorize_tags_b": grouped(AUTO.format("tag_string_general"), DATASET_RULES),
    "default_ids": """WITH placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'doc_' || doc_id ELSE 'sample_' || pos END AS id,
       CASE WHEN doc_id % 4 = 0 THEN 'doc_' || doc_id ELSE 'batch_' || (pos - pos % 8) || '_' || (pos % 8) END AS batch_id
FROM placed""",
    "assign_batches": """SELECT doc_id, n_chars, (row_number() OVER (ORDER BY n_chars, doc_id) - 1) // 16 AS batch
FROM documents""",
    "take_samples": "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50",
    "skip_take": "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50 OFFSET 100",
    "read_processed_ids": f"WITH {PRIOR} SELECT DISTINCT id FROM f7ids WHERE id IS NOT NULL",
    "processed_id_log": f"WITH {PRIOR} SELECT DISTINCT id FROM f7ids WHERE id IS NOT NULL",
    "last_processed": f"WITH {PRIOR} SELECT id FROM f7ids WHERE id IS NOT NULL ORDER BY conv_id DESC, turn DESC LIMIT 1",
    "resume_anti": f"WITH {ITEMS}, {DONE} SELECT id, lang FROM items WHERE id NOT IN (SELECT id FROM done)",
    "resume_limit": f"""WITH {ITEMS}, {DONE}
SELECT id, doc_id FROM items WHERE id NOT IN (SELECT id FROM done) ORDER BY doc_id LIMIT 100""",
    "resume_cursor": f"""WITH {ITEMS}, {DONE},
last AS (SELECT doc_id FROM labels ORDER BY toxic DESC, quality DESC, doc_id DESC LIMIT 1)
SELECT id, doc_id FROM items WHERE doc_id > (SELECT doc_id FROM last) AND id NOT IN (SELECT id FROM done)""",
    "progress_stats": f"""WITH {ITEMS}, {DONE}
SELECT count(*) AS total, count(*) FILTER (WHERE id IN (SELECT id FROM done)) AS processed,
       count(*) FILTER (WHERE id NOT IN (SELECT id FROM done)) AS remaining FROM items""",
    "remaining_ids": f"WITH {ITEMS}, {DONE} SELECT id FROM items EXCEPT SELECT id FROM done",
    "cache_keys": """SELECT doc_id, md5('text:' || text) AS text_key, md5('image:' || text) AS image_key FROM documents""",
    "cache_lookup": f"""WITH c AS (
  SELECT md5('text:' || text) AS hash_key, {pick('Age', 'max(quality) + 1')} AS age
  FROM documents JOIN labels USING (doc_id) GROUP BY 1
)
SELECT doc_id, c.hash_key IS NOT NULL AS hit, c.age AS "Age"
FROM documents d LEFT JOIN c ON c.hash_key = md5('text:' || d.text)""",
    "cache_upsert": f"WITH {LATEST} SELECT hash_key, attributes, {STAMP.format('ts')} AS ts, seq FROM upserted",
    "cache_stats": f"""WITH {LATEST}
SELECT true AS enabled, count(*) AS entries, {STAMP.format('min(ts)')} AS oldest, {STAMP.format('max(ts)')} AS newest
FROM upserted""",
    "score_distinct": f"""WITH {CAPTIONS}
SELECT c_custkey, md5('text:' || caption) AS hash_key, {lexical_columns('caption')} FROM f1""",
    "extract_cached": f"""WITH {CAPTIONS},
cached AS (
  SELECT DISTINCT caption FROM f1 JOIN customer USING (c_custkey) WHERE c_acctbal < 0 AND caption IS NOT NULL
),
fresh AS (SELECT c_custkey, {lexical_columns('caption')} FROM f1)
SELECT c_custkey, c.caption IS NOT NULL AS hit,
  {", ".join(f"CASE WHEN c.caption IS NULL THEN fresh.{n}" + (" ELSE 'elderly'" if n == "Age" else "") + f" END AS {n}" for n in NAMES)}
FROM f1 JOIN fresh USING (c_custkey) LEFT JOIN cached c ON c.caption = f1.caption""",
    "cache_table": """SELECT hash_key, k FROM (
  SELECT md5(CAST(user_id AS VARCHAR)) AS hash_key, json_extract_string(props, '$.k') AS k,
         row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, ts DESC, event_id DESC) AS rn
  FROM events
) WHERE rn = 1""",
    "shard_report": f"""WITH {MEMBERS},
shards AS (  -- a header block and whole blocks per member, two closing blocks, in records of 20 blocks
  SELECT ceil((sum(512 + ceil(size / 512.0) * 512) + 1024) / 10240.0) * 10240 AS bytes
  FROM f2 GROUP BY doc_id // {DOCS_PER_SHARD}
),
ids AS (SELECT DISTINCT id FROM f2 WHERE id IS NOT NULL)
SELECT count(*) AS total_files, count(*) FILTER (WHERE {KIND} = 'image') AS image_files,
       count(*) FILTER (WHERE {KIND} = 'text') AS text_files, count(DISTINCT id) AS unique_ids,
       (SELECT round(sum(bytes) / 1048576.0::DOUBLE, 6) FROM shards) AS size_mb, (SELECT count(*) FROM ids) AS total,
       (SELECT count(*) FROM ids WHERE id IN (SELECT 'item_' || doc_id FROM labels)) AS processed,
       (SELECT count(*) FROM ids WHERE id NOT IN (SELECT 'item_' || doc_id FROM labels)) AS remaining
FROM f2""",
    "extract_with_errors": f"""WITH {MEMBERS}, {MARKERS.format(source=f"(SELECT * FROM f2 WHERE {KIND} = 'image')")}
SELECT m.pos, CASE WHEN w.pos IS NULL THEN 'not an image' END AS error, {columns('w.')}
FROM markers m LEFT JOIN wide w ON w.pos = m.pos""",
    "extract_pairs": f"""WITH {PAIRS}, {ZERO_SHOT},
done AS (
  SELECT p.id, p.image, p.text, CASE WHEN p.image IS NOT NULL THEN 'image' ELSE 'text' END AS source,
    CASE WHEN p.image IS NOT NULL AND w.vec_id IS NULL THEN 'image_load_failed' END AS error,
    {", ".join(f"w.{n} AS i_{n}" for n in NAMES)}
  FROM pairs p LEFT JOIN wide w ON p.id = 'item_' || w.vec_id
)
SELECT d.id, d.source, d.error,
  {", ".join(f"CASE WHEN d.source = 'image' THEN d.i_{n} ELSE t.{n} END AS {n}" for n in NAMES)},
  CASE WHEN d.source = 'text' OR length(d.text) > 0 THEN CAST(len(string_split(d.text, ',')) AS INT) END AS tag_count
FROM done d JOIN (SELECT id, {lexical_columns('text')} FROM pairs) t ON t.id = d.id""",
    "result_json_lines": f"""WITH {RESULTS}
SELECT '{{"id":"' || vec_id || '","attributes":' || {JSON_RECORD} || ',"source":"image","processing_time":0.0,"error":' ||
  CASE WHEN error IS NULL THEN 'null' ELSE '"' || error || '"' END || '}}' AS line FROM res""",
    "append_results": f"""SELECT CAST(doc_id AS VARCHAR) AS id, 'text' AS source,
  array_to_string(list_transform(string_split(text, ','), lambda t: {STRIP.format('t')}), '|') AS tags,
  CAST(NULL AS VARCHAR) AS error FROM documents""",
    "merge_results": f"""WITH {ITEMS}, {DONE}
SELECT id, 'text' AS source, CAST(NULL AS INT) AS tag_count FROM done
UNION ALL SELECT id, 'image', CAST(len(string_split(text, ',')) AS INT) FROM items WHERE id NOT IN (SELECT id FROM done)""",
    "run_summary": f"""WITH {RESULTS},
flags AS (SELECT error IS NULL AS fine, coalesce({columns()}) IS NOT NULL AS has_any, hit FROM res)
SELECT count(*) AS total, count(*) FILTER (WHERE fine AND has_any) AS successful,
  count(*) FILTER (WHERE NOT (fine AND has_any)) AS failed, count(*) FILTER (WHERE fine) AS no_error,
  count(*) FILTER (WHERE NOT fine) AS errors, count(*) FILTER (WHERE hit) AS cache_hits,
  count(*) FILTER (WHERE NOT hit AND fine) AS computed FROM flags""",
    "batch_summary": """WITH placed AS (
  SELECT vec_id % 19 = 0 AS bad, (row_number() OVER (ORDER BY vec_id) - 1) // 16 AS batch FROM embeddings
)
SELECT batch, count(*) FILTER (WHERE NOT bad) AS success_count, count(*) FILTER (WHERE bad) AS error_count
FROM placed GROUP BY batch""",
    "dataset_stats": f"""WITH {CAPTIONS}
SELECT count(*) AS total_samples, 'c_custkey,caption,tag_string_general,general' AS sample_keys,
  (SELECT CAST(coalesce(len(general), 0) AS INT) FROM f1 ORDER BY c_custkey LIMIT 1) AS sample_tags FROM f1""",
    "stream_pairs": STEM_PAIRS,
    "stream_dedup": """SELECT DISTINCT md5(text) AS id FROM documents
WHERE md5(text) NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id))""",
    "stream_extract": f"""WITH {CAPTIONS}
SELECT CAST(c_custkey AS VARCHAR) AS id, 'caption' AS source, CAST(NULL AS VARCHAR) AS error,
  {lexical_columns('caption')} FROM f1""",
    "stream_cache": f"WITH {LATEST} SELECT hash_key, json_extract_string(attributes, '$.k') AS k FROM upserted",
    "shard_job_results": f"""WITH {PAIRS},
firsts AS (
  SELECT p.id, p.text, f.pos, f.payload FROM pairs p
  LEFT JOIN f2 f ON f.id = p.id AND f.name = p.image
  WHERE p.id NOT IN (SELECT 'item_' || doc_id FROM labels)
),
{MARKERS.format(source="(SELECT * FROM firsts WHERE pos IS NOT NULL)")}
SELECT f.id, CASE WHEN f.pos IS NOT NULL THEN 'image' ELSE 'text' END AS source,
  CASE WHEN f.pos IS NOT NULL AND w.pos IS NULL THEN 'not an image' END AS error,
  {", ".join(f"CASE WHEN f.pos IS NOT NULL THEN w.{n} ELSE t.{n} END AS {n}" for n in NAMES)},
  CASE WHEN f.pos IS NULL OR length(f.text) > 0 THEN CAST(len(string_split(f.text, ',')) AS INT) END AS tag_count
FROM firsts f LEFT JOIN wide w ON w.pos = f.pos
JOIN (SELECT id, {lexical_columns('text')} FROM pairs) t ON t.id = f.id""",
    "dataset_job_results": f"""WITH {CAPTIONS}, tagged AS (SELECT *, {TAG_SOURCE} AS t FROM f1)
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN caption IS NULL THEN 'unknown' ELSE 'caption' END AS source,
  CASE WHEN caption IS NULL THEN 'no_input' END AS error,
  {lexical_columns('caption')}, CAST(len(t) AS INT) AS tag_count FROM tagged""",
    "dataset_job_images": f"""WITH f11 AS (
  SELECT doc_id AS pos, CAST(doc_id AS VARCHAR) AS id, doc_id % 3 = 0 AS pictured,
    CASE WHEN doc_id % 11 = 0 THEN 'bad:' ELSE 'img:' END || md5(CAST(doc_id % 100 AS VARCHAR)) AS payload,
    CASE WHEN doc_id % 2 = 0 THEN text END AS text,
    CASE WHEN doc_id % 5 = 0 THEN 'caption ' || lang END AS caption
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
),
used AS (SELECT *, coalesce(text, caption) AS words FROM f11),
{MARKERS.format(source="(SELECT * FROM f11 WHERE pictured)").removeprefix("WITH ")}
SELECT f.id, CASE WHEN pictured THEN 'image' WHEN text IS NOT NULL THEN 'text'
    WHEN caption IS NOT NULL THEN 'caption' ELSE 'unknown' END AS source,
  CASE WHEN pictured THEN CASE WHEN w.pos IS NULL THEN 'not an image' END
    WHEN words IS NULL THEN 'no_input' END AS error,
  {", ".join(f"CASE WHEN pictured THEN w.{n} ELSE t.{n} END AS {n}" for n in NAMES)},
  CAST(NULL AS INT) AS tag_count
FROM used f LEFT JOIN wide w ON w.pos = f.pos
JOIN (SELECT id, {lexical_columns('words')} FROM used) t ON t.id = f.id""",
    "wave_job_results": f"""WITH {CAPTIONS}, tagged AS (SELECT *, {TAG_SOURCE} AS t FROM f1)
SELECT CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey - c_custkey % 2 AS VARCHAR) ELSE 'made' END AS id,
  CASE WHEN caption IS NULL THEN 'unknown' ELSE 'caption' END AS source,
  CASE WHEN caption IS NULL THEN 'no_input' END AS error,
  {lexical_columns('caption')}, CAST(len(t) AS INT) AS tag_count FROM tagged""",
    "directory_job_results": f"""WITH {PICTURES}, {VOCABULARY},
pscores AS (
  SELECT k, attribute, option, opt_idx, CAST((width + ordinal) % 7 AS DOUBLE) AS score
  FROM f10 CROSS JOIN vocab WHERE mode <> 'junk' AND ending <> '.txt'
),
{winners('pscores', 'k')}
SELECT f.id, 'unknown' AS source, CASE WHEN f.mode = 'junk' THEN 'image_load_failed' END AS error, {columns('w.')}
FROM f10 f LEFT JOIN wide w ON w.k = f.k WHERE f.ending <> '.txt'""",
}
