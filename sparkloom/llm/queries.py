"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkloom.llm.decontaminate import contamination
from sparkloom.llm.importance import importance_filter
from sparkloom.llm.jaccard_join import jaccard_join
from sparkloom.llm.language import fit_language, predict_language
from sparkloom.llm.mixing import mix_sources, token_count
from sparkloom.llm.personal_data import find_personal_data
from sparkloom.llm.prefix_trie import own_turns, prefix_trie, rebuilt
from sparkloom.llm.sharding import uniform_shards
from sparkloom.llm.tensor_dedup import near_duplicates
from sparkloom.llm.url_rules import judge_urls
from sparkloom.llm.warc import read_warc, write_warc
from sparkloom.llm.weak_labels import weak_label_quality
from sparkloom.llm.whitening import whiten
from sparkloom.llm.workspace import Workspace, text_session
from sparkloom.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# What the mixing query aims at: whole-number weights of the tree's values.
MIX_WEIGHTS = {"domain": {"lower": 1, "upper": 3}, "lang": {"en": 2, "de": 3, "fr": 3, "es": 2}}


def mix_tree() -> dict[str, Column]:
    """Domain (by the last digit of the source), language, source."""
    last = F.substring("source", -1, 1)
    domain = F.when(last.between("0", "4"), "lower").when(last.between("5", "9"), "upper")
    return {"domain": domain.otherwise("other"), "lang": F.col("lang"), "source": F.col("source")}


def query(sql: str | None = None):
    """Register under the function's name; the function takes a reader of tables."""
    def register(fn):
        QUERIES[fn.__name__] = lambda spark, root: fn(
            lambda name: read_table(text_session(spark), root, name))
        if sql:
            SQL[fn.__name__] = sql.strip()
        return fn
    return register


def held_out(id_col: str = "doc_id"):
    """Rows that a language model must not learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def groups_sql(words: int, percent: int, columns: str) -> str:
    """All pairs with a common shingle, counted, and the groups that links make."""
    return f"""
    WITH RECURSIVE texts AS (
      SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
    shingles AS (
      SELECT doc_id, unnest(list_distinct(list_transform(
        range(1, greatest(len(w) - {words} + 1, least(len(w), 1)) + 1),
        lambda i: array_to_string(w[i:i + {words} - 1], ' ')))) AS shingle FROM texts),
    sizes AS (
      SELECT doc_id, count(shingle)::BIGINT AS n FROM texts LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
    links AS (
      SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id != y.doc_id GROUP BY ALL)
      JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
      WHERE 100 * common >= {percent} * (s.n + t.n - common)),
    degrees AS (SELECT a AS doc_id, count(*)::BIGINT AS n_links FROM links GROUP BY a),
    reached(doc_id, other) AS (
      SELECT doc_id, doc_id FROM sizes UNION SELECT doc_id, b FROM reached JOIN links ON a = other),
    named AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, n AS n_shingles, component_id, {columns}
    FROM sizes JOIN named USING (doc_id) LEFT JOIN degrees USING (doc_id)
    """


@query(groups_sql(4, 85, "coalesce(n_links, 0) AS n_links"))
def op1_jaccard_join(table):
    return jaccard_join(table("documents"), words=4, percent=85)[0]


# Verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("""
    WITH parts AS (
      SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
      FROM pages),
    rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
      ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    fits AS (
      SELECT page_id, any_value(host) AS host, any_value(path) AS path,
        max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
      FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
""")
def op2_url_rules(table):
    return judge_urls(table("pages").select("page_id", "url"), URL_RULES).drop("url")


@query()
def op3_uniform_shards(table):
    text = F.coalesce("text", F.lit(""))
    docs = table("documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                     F.crc32(text).alias("text_crc32"))
    return uniform_shards(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query()
def op4_warc(table):
    pages = table("pages")
    work = Workspace(pages.sparkSession, "warc")
    files = write_warc(pages.select("page_id", "url", "html"), work)
    return read_warc(files, work.root).select("page_id", "payload_bytes", "payload_digest",
                                              "record_type", "refers_to")


@query()
def op5_importance(table):
    trusted = table("labels").where("quality = 1")
    return importance_filter(table("documents"), trusted)


@query()
def op6_personal_data(table):
    return find_personal_data(table("documents"))


@query()
def op7_weak_labels(table):
    return weak_label_quality(table("documents"))


@query("""
    WITH docs AS (
      SELECT doc_id, lang, source, CASE WHEN right(source, 1) BETWEEN '0' AND '4' THEN 'lower'
          WHEN right(source, 1) BETWEEN '5' AND '9' THEN 'upper' ELSE 'other' END AS domain,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
      FROM documents),
    leaves AS (
      SELECT domain, coalesce(lang, '') AS l, coalesce(source, '') AS s, sum(tokens)::BIGINT AS tokens
      FROM docs WHERE tokens > 0 GROUP BY ALL),
    d0 AS (
      SELECT domain, sum(tokens)::BIGINT * 2 AS room,
        CASE domain WHEN 'lower' THEN 1 WHEN 'upper' THEN 3 ELSE 1 END AS weight,
        (SELECT sum(tokens)::BIGINT * 3 // 5 FROM leaves) AS budget FROM leaves GROUP BY domain),
    d1 AS (SELECT *, room * (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))
        <= (budget - coalesce(sum(room) OVER w, 0)) * weight AS is_full FROM d0
      WINDOW w AS (ORDER BY room::DOUBLE / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    d2 AS (SELECT *, budget - sum(CASE WHEN is_full THEN room ELSE 0 END) OVER () AS rest,
        sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS opened FROM d1),
    d3 AS (SELECT *, CASE WHEN is_full THEN room ELSE rest * weight // opened END AS part FROM d2),
    d4 AS (SELECT domain, part + CASE WHEN NOT is_full AND sum(CASE WHEN is_full THEN 0 ELSE 1 END)
          OVER (ORDER BY room::DOUBLE / weight, domain ROWS UNBOUNDED PRECEDING)
          <= rest - sum(CASE WHEN is_full THEN 0 ELSE part END) OVER () THEN 1 ELSE 0 END AS budget FROM d3),
    l0 AS (
      SELECT domain, l, sum(tokens)::BIGINT * 2 AS room, any_value(budget) AS budget,
        CASE l WHEN 'en' THEN 2 WHEN 'de' THEN 3 WHEN 'fr' THEN 3 WHEN 'es' THEN 2 ELSE 1 END AS weight
      FROM leaves JOIN d4 USING (domain) GROUP BY domain, l),
    l1 AS (SELECT *, room * (sum(weight) OVER (PARTITION BY domain) - coalesce(sum(weight) OVER w, 0))
        <= (budget - coalesce(sum(room) OVER w, 0)) * weight AS is_full FROM l0
      WINDOW w AS (PARTITION BY domain ORDER BY room::DOUBLE / weight, l
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l2 AS (SELECT *, budget - sum(CASE WHEN is_full THEN room ELSE 0 END) OVER (PARTITION BY domain) AS rest,
        sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain) AS opened FROM l1),
    l3 AS (SELECT *, CASE WHEN is_full THEN room ELSE rest * weight // opened END AS part FROM l2),
    l4 AS (SELECT domain, l, part + CASE WHEN NOT is_full AND sum(CASE WHEN is_full THEN 0 ELSE 1 END)
          OVER (PARTITION BY domain ORDER BY room::DOUBLE / weight, l ROWS UNBOUNDED PRECEDING)
          <= rest - sum(CASE WHEN is_full THEN 0 ELSE part END) OVER (PARTITION BY domain)
          THEN 1 ELSE 0 END AS budget FROM l3),
    s0 AS (SELECT domain, l, s, tokens, tokens * 2 AS room, 1 AS weight, budget
      FROM leaves JOIN l4 USING (domain, l)),
    s1 AS (SELECT *, room * (sum(weight) OVER (PARTITION BY domain, l) - coalesce(sum(weight) OVER w, 0))
        <= (budget - coalesce(sum(room) OVER w, 0)) * weight AS is_full FROM s0
      WINDOW w AS (PARTITION BY domain, l ORDER BY room::DOUBLE / weight, s
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    s2 AS (SELECT *,
        budget - sum(CASE WHEN is_full THEN room ELSE 0 END) OVER (PARTITION BY domain, l) AS rest,
        sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain, l) AS opened FROM s1),
    s3 AS (SELECT *, CASE WHEN is_full THEN room ELSE rest * weight // opened END AS part FROM s2),
    s4 AS (SELECT domain, l, s, tokens AS leaf, part + CASE WHEN NOT is_full
          AND sum(CASE WHEN is_full THEN 0 ELSE 1 END) OVER (PARTITION BY domain, l
            ORDER BY room::DOUBLE / weight, s ROWS UNBOUNDED PRECEDING)
          <= rest - sum(CASE WHEN is_full THEN 0 ELSE part END) OVER (PARTITION BY domain, l)
          THEN 1 ELSE 0 END AS budget FROM s3),
    ranked AS (
      SELECT d.*, (budget // leaf)::BIGINT AS epochs, budget % leaf AS rest,
        sum(d.tokens) OVER (PARTITION BY d.domain, l, s
          ORDER BY md5('29:' || (budget // leaf)::BIGINT || ':' || doc_id), doc_id, d.tokens
          ROWS UNBOUNDED PRECEDING) AS upto
      FROM docs d JOIN s4 ON s4.domain = d.domain AND l = coalesce(lang, '') AND s = coalesce(source, '')
      WHERE d.tokens > 0)
    SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens,
      (epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::INT AS copies
    FROM ranked WHERE epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
""")
def op8_mixing(table):
    docs = table("documents").select("doc_id", "lang", "source", token_count().alias("tokens"))
    docs = Workspace(docs.sparkSession, "mixing").keep("tokens", docs)   # the texts are read once
    return mix_sources(docs, mix_tree(), MIX_WEIGHTS, F.col("tokens"), share=(3, 5), max_epochs=2).select(
        "doc_id", mix_tree()["domain"].alias("domain"), "lang", "source", "tokens", F.col("__copies").alias("copies"))


@query()
def op9_language(table):
    docs = table("documents")
    model = fit_language(docs, ~held_out("id"))
    return predict_language(docs.select("doc_id", "text", held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


@query("""
    WITH d AS (
      SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, size, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS run
      FROM (SELECT item_id, w, least(13, len(w)) AS size,
              unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
    runs AS (
      SELECT doc_id, i, size, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS run
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
    met AS (SELECT doc_id, i, size, item_id FROM runs JOIN windows USING (size, run)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id),
    names AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
      FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
      coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)
""")
def op10_decontaminate(table):
    return contamination(table("documents"), table("benchmark")).drop("row_key")


@query(groups_sql(2, 80, "doc_id = component_id AS kept"))
def op11_tensored_minhash(table):
    return near_duplicates(table("documents"), words=2, percent=80)


@query("""
    WITH own AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
      FROM conversations WHERE conv_id IS NOT NULL),
    heads AS (
      SELECT conv_id, conv_id - conv_id % 20 AS head, xor(4294967295, list_reduce(
          list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
          lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
            lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM own)),
    rebuilt AS (
      SELECT heads.conv_id, own.role, own.text, place, 0 AS part
      FROM heads JOIN own ON own.conv_id = head WHERE place <= h
      UNION ALL
      SELECT conv_id, role, text, place, 1 FROM heads JOIN own USING (conv_id) WHERE place > h),
    turns AS (
      SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS d FROM rebuilt),
    seqs AS (
      SELECT heads.conv_id, coalesce(list({'r': role, 't': text} ORDER BY d) FILTER (d IS NOT NULL), []) AS seq
      FROM heads LEFT JOIN turns USING (conv_id) GROUP BY heads.conv_id),
    paths AS (
      SELECT conv_id, len(seq) AS turns, unnest(range(0, len(seq) + 1)) AS depth, seq FROM seqs),
    nodes AS (
      SELECT depth, seq[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
      FROM paths GROUP BY depth, seq[1:depth]),
    kin AS (
      SELECT n.*, p.conv_id AS parent_conv_id, (n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE
          len(regexp_extract_all(path[n.depth].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
      FROM nodes n LEFT JOIN (SELECT depth + 1 AS depth, path AS up, conv_id FROM nodes) p
        ON p.depth = n.depth AND p.up = n.path[1:n.depth - 1]),
    family AS (
      SELECT a.depth, a.conv_id, b.depth AS below, b.conv_id AS member, b.saved,
        NOT EXISTS (SELECT 1 FROM nodes c WHERE c.depth = b.depth + 1 AND c.path[1:b.depth] = b.path) AS leaf
      FROM kin a JOIN kin b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path)
    SELECT k.conv_id, k.depth, parent_conv_id, n_convs,
      count(*) FILTER (below = f.depth + 1)::BIGINT AS n_children, count(*) FILTER (leaf)::BIGINT AS n_leaves,
      sum(f.saved)::BIGINT AS saved_tokens, ends_sha256
    FROM kin k JOIN family f ON f.depth = k.depth AND f.conv_id = k.conv_id
    GROUP BY k.conv_id, k.depth, parent_conv_id, n_convs, ends_sha256
""")
def op12_prefix_trie(table):
    return prefix_trie(rebuilt(own_turns(table("conversations"))))


@query()
def op13_whitening(table):
    return whiten(table("embeddings"))
