"""The queries of this subpackage, one per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_ESCAPED = r"replace(replace(replace({}, '\', '\e'), '</turn>', '\t'), '###', '\h')"


@query(
    "op1_chat_format",
    rf"""
    WITH lines AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length('### : </turn>') + 1 + length(replace({_ESCAPED.format("role")}, ':', '\c')) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
    FROM lines GROUP BY conv_id
    """,
)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.chat import formatted, linear_trees, read_back

    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(formatted(linear_trees(rows)))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), "n_turns", F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def _url_sql(order: int = 4) -> str:
    from daygrid.llm.urls import ALPHABET, HELD, RULES, STEP

    longest = sorted(RULES, key=lambda r: len(r.host + r.path), reverse=True)
    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in longest]
    case = lambda value: "CASE " + " ".join(f"WHEN {own} THEN '{value(r)}'" for own, r in fits) + " END"
    levels = []
    for k in range(order + 1):
        below = f"JOIN p{k - 1} q ON q.g = substr(l.g, 2)" if k else f"CROSS JOIN (SELECT cast('{1 / ALPHABET!r}' as double) AS pa, cast('{1 / ALPHABET!r}' as double) AS pb) q"
        levels.append(f"""
    l{k} AS (SELECT substr(g, {order - k + 1}) AS g, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM grams GROUP BY 1),
    t{k} AS (SELECT substr(g, 1, {k}) AS h, sum(a) AS na, sum(b) AS nb, (count(*) FILTER (a > 0))::DOUBLE AS ta, (count(*) FILTER (b > 0))::DOUBLE AS tb FROM l{k} GROUP BY 1),
    p{k} AS (SELECT l.g, CASE WHEN na > 0 THEN (a + ta * pa) / (na + ta) ELSE pa END AS pa, CASE WHEN nb > 0 THEN (b + tb * pb) / (nb + tb) ELSE pb END AS pb
        FROM l{k} l JOIN t{k} t ON substr(l.g, 1, {k}) = t.h {below})""")
    return rf"""
    WITH u AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), hosts AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
    ), known AS (
        SELECT *, regexp_replace(host || path, '[^\x21-\x7e]', chr(1), 'g') AS text, {case(lambda r: r.host + r.path)} AS rule, {case(lambda r: r.verdict)} AS verdict FROM hosts
    ), texts AS (
        SELECT text, substr(md5(text), 1, 1) IN {HELD} AS held, count(*) FILTER (verdict = 'allow') AS all_a, count(*) FILTER (verdict = 'block') AS all_b,
            CASE WHEN held THEN 0 ELSE all_a END AS a, CASE WHEN held THEN 0 ELSE all_b END AS b FROM known GROUP BY text
    ), spread AS (
        SELECT text, a, b, held, all_a, all_b, substr('{" " * order}' || text || chr(2), i, {order + 1}) AS g FROM (SELECT *, unnest(range(1, length(text) + 2)) AS i FROM texts)
    ), grams AS (
        SELECT g, sum(a) AS a, sum(b) AS b FROM spread GROUP BY g
    ), {", ".join(levels)}, scores AS (
        SELECT text, any_value(held) AS held, any_value(all_a) AS a, any_value(all_b) AS b, CASE WHEN (SELECT sum(a) > 0 AND sum(b) > 0 FROM texts) THEN avg(round(ln(pa) - ln(pb), 9)) ELSE 0 END AS score
        FROM spread s JOIN p{order} p USING (g) GROUP BY text
    ), bins AS (
        SELECT greatest(cast('-20' as double), least(cast('20' as double), floor(score / cast('{STEP}' as double)) * cast('{STEP}' as double))) AS cut, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM scores WHERE held AND a + b > 0 GROUP BY 1
    ), ranked AS (
        SELECT cut, (total_a - (sum(a) OVER up - a)) / total_a + (sum(b) OVER up - b) / total_b AS right_share
        FROM bins, (SELECT sum(a) AS total_a, sum(b) AS total_b FROM bins) WHERE total_a > 0 AND total_b > 0 WINDOW up AS (ORDER BY cut)
    ), chosen AS (
        SELECT coalesce((SELECT cut FROM ranked ORDER BY right_share DESC, abs(cut), cut LIMIT 1), 0) AS cut
    )
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict, CASE WHEN rule IS NULL THEN round(score, 6) END AS score
    FROM known JOIN scores USING (text), chosen
    """


@query("op4_url_filter", _url_sql())
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.urls import judged

    return judged(table(spark, sf_dir, "pages").select("page_id", "url")).withColumn("score", F.round("score", 6))


@query(
    "op8_benchmark_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
    ), b AS (
        SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
    ), i AS (
        SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + 12], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS p FROM b WHERE len(w) > 0)
    ), places AS (
        SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) AS ns)
    ), found AS (
        SELECT DISTINCT doc_id, p, places.n, item_id FROM places JOIN i ON places.win = i.win AND places.n = i.n
    ), covered AS (
        SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.decontaminate import hits

    found = hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op7_bag_minhash_dedup")
def bag_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.neardup import groups, stays

    found = groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", stays().alias("kept"))


@query("op3_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.toxicity import judged

    return judged(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


@query("op9_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.pii import fitted, found

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return found(docs, fitted(docs))


@query(
    "op6_quality_rules",
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), windows AS (
        SELECT doc_id, n, p, count(*) OVER (PARTITION BY doc_id, n, md5(array_to_string(w[p : p + n - 1], ' '))) > 1 AS twice
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (VALUES (3), (10), (101)) AS ns(n))
    ), covered AS (
        SELECT doc_id, n, count(DISTINCT q) AS places FROM (SELECT doc_id, n, unnest(range(p, p + n)) AS q FROM windows WHERE twice) GROUP BY doc_id, n
    ), numbers AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines,
            coalesce((SELECT places FROM covered c WHERE c.doc_id = d.doc_id AND n = 3), 0)::BIGINT AS n_repeat_words,
            coalesce((SELECT places FROM covered c WHERE c.doc_id = d.doc_id AND n = 10), 0)::BIGINT AS covered_words,
            coalesce((SELECT places FROM covered c WHERE c.doc_id = d.doc_id AND n = 101), 0)::BIGINT AS too_long
        FROM d
    )
    SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * covered_words <= 3 * n_words AND too_long = 0 AS kept
    FROM numbers
    """,
)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.repetition import judged

    return judged(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("covered_words", "longest_repeat")


@query("op5_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.pages import extracted

    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.char_length("text").cast("bigint"))


def _license_sql() -> str:
    from daygrid.llm.licenses import NOTICES

    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(NOTICES))
    words = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
    WITH RECURSIVE sizes AS (
        SELECT 5 AS size UNION ALL SELECT size + greatest(2, size // 4) FROM sizes WHERE size < 1000
    ), n AS (
        SELECT notice, license_id, w, (SELECT min(size) FROM sizes WHERE size >= len(w)) AS size FROM (SELECT notice, license_id, {words} AS w FROM (VALUES {rows}) AS v(notice, license_id, text))
    ), s AS (
        SELECT DISTINCT notice, license_id, size, greatest(1, (size - 4) // 4) AS step, array_to_string(w[p : p + 4], ' ') AS shingle FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM n)
    ), totals AS (
        SELECT notice, count(*) AS total FROM s GROUP BY notice
    ), d AS (
        SELECT doc_id, {words} AS w FROM documents
    ), places AS (
        SELECT doc_id, p - 1 AS p, array_to_string(w[p : p + 4], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d)
    ), cells AS (
        SELECT doc_id, notice, license_id, s.shingle, unnest(range(greatest(0, ceil((p + 5 - size - step) / step))::BIGINT, (p // step) + 1)) AS cell FROM places JOIN s USING (shingle)
    ), shares AS (
        SELECT doc_id, license_id, max(share) AS share FROM (
            SELECT doc_id, license_id, count(DISTINCT shingle) / any_value(total) AS share FROM cells JOIN totals USING (notice) GROUP BY doc_id, notice, license_id, cell
        ) WHERE share >= 0.8 GROUP BY doc_id, license_id
    ), own AS (
        SELECT doc_id, count(*) AS n_licenses, string_agg(license_id, ',' ORDER BY license_id) AS licenses, round(max(share), 6) AS best FROM shares GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(licenses, '') AS licenses, coalesce(best, cast('0' as double)) AS best_containment FROM documents LEFT JOIN own USING (doc_id)
    """


@query("op2_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.licenses import notices, scanned

    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), notices(spark))
    return found.select(
        "doc_id", F.size("licenses").cast("bigint").alias("n_licenses"), F.array_join("licenses.license_id", ",").alias("licenses"),
        F.round(F.coalesce(F.array_max("licenses.containment"), F.lit(0.0)), 6).alias("best_containment"),
    )


def _secret_sql() -> str:
    from daygrid.llm.secrets import BASE, RULES

    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    families = list(dict.fromkeys(r.family for r in RULES))
    columns, lists, spans = [], [], []
    for f, family in enumerate(families):
        own = [(k, r) for k, r in enumerate(RULES) if r.family == family]
        # A bounded rule takes the mark before it along, which is cut off again; between two matches there is always one.
        pattern = quoted("|".join(f"(?:(?:^|[^A-Za-z0-9_-])(?:{r.pattern}))" if r.bounded else f"(?:{r.pattern})" for _, r in own))
        columns.append(f"regexp_extract_all(text, {pattern}) AS hits{f}, list_transform(regexp_split_to_array(text, {pattern}), lambda x: length(x)) AS gaps{f}")
        extra = "if(regexp_matches(h, '^[^A-Za-z0-9_-]'), 1, 0)" if any(r.bounded for _, r in own) else "0"
        lists.append(f"""list_transform(hits{f}, lambda h, i: {{'s': list_sum(gaps{f}[1:i]) + coalesce(list_sum(list_transform(hits{f}[1 : i - 1], lambda x: length(x))), 0) + {extra}, 'h': h[{extra} + 1 :]}}) AS found{f}""")
        rule = " ".join(f"WHEN regexp_full_match(m.h, {quoted(r.pattern)}) THEN if(regexp_full_match(m.h, {quoted(r.kept)}), {k}, -1)" for k, r in own)
        spans.append(f"list_transform(found{f}, lambda m: {{'s': m.s::BIGINT, 'k': CASE {rule} ELSE -1 END, 'e': (m.s + length(m.h))::BIGINT}})")
    names = ", ".join(f"'{r.kind}'" for r in RULES)
    written = "array_to_string(list_transform({}, lambda m: ([{}])[m.k + 1] || ':' || m.s || ':' || m.e), ',')"
    counts = ", ".join(f"len(list_filter(spans, lambda m: m.k = {k}))::BIGINT AS n_{RULES[k].kind}" for k in range(BASE))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    h AS (SELECT doc_id, {", ".join(columns)} FROM d),
    f AS (SELECT doc_id, {", ".join(lists)} FROM h),
    s AS (SELECT doc_id, list_sort(list_filter(flatten([{", ".join(spans)}]), lambda m: m.k >= 0)) AS spans FROM f)
    SELECT doc_id, {counts}, sha256({written.format(f"list_filter(spans, lambda m: m.k < {BASE})", names)}) AS base_sha256, {written.format("spans", names)} AS spans FROM s
    """


@query("op12_secret_scan", _secret_sql())
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.secrets import BASE, RULES, found

    kinds = [r.kind for r in RULES[:BASE]]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds]
    return found(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query(
    "op13_spelling_variants",
    r"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda k: list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ), runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{5,}')) AS run FROM documents
    ), counted AS (
        SELECT run, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes, count(*) AS n FROM runs GROUP BY ALL
    ), hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(
            [4294967295] || list_transform(range(1, length(bytes), 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM counted, crc
    ), kept AS (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
    ), words AS (
        SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
    ), gaps AS (
        SELECT word, i, left(word, i) || '*' || substr(word, i + 2) AS pattern, left(word, i) || substr(word, i + 2) AS less
        FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
    ), near AS (
        SELECT a.word, b.word AS other FROM gaps a JOIN gaps b USING (pattern) WHERE a.word <> b.word
        UNION SELECT word, less FROM gaps WHERE less IN (SELECT word FROM words)
        UNION SELECT less, word FROM gaps WHERE less IN (SELECT word FROM words)
    ), best AS (
        SELECT near.word, count(*)::BIGINT AS n_near, arg_min(other, (-o.n, other)) AS near, max(o.n) AS near_n FROM near JOIN words o ON o.word = other GROUP BY near.word
    ), forms AS (
        SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * words.n THEN near END AS form, CASE WHEN near_n >= 2 * words.n THEN near_n END AS form_n
        FROM words LEFT JOIN best USING (word)
    ), chain AS (
        SELECT word, word AS at FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON chain.at = forms.word WHERE form IS NOT NULL
    )
    SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain USING (word) JOIN forms last ON last.word = chain.at AND last.form IS NULL
    """,
)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def two_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daygrid.llm.alignment import alignment

    return alignment(table(spark, sf_dir, "documents").select("doc_id", "text"), *two_tokenizers())
