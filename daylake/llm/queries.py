"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.llm import (
    decontaminate,
    html,
    langid,
    lm,
    packing,
    periodic,
    phrases,
    pii,
    quality,
    secrets,
    simhash,
    warc,
    whitening,
)
from daylake.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public vocabulary files have `name`."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("payload")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identified(docs, langid.fit_model(langid.sample(docs)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of documents in which some repeat themselves; the longest run, and digests of all and of what is kept."""
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), repeats=periodic.planted_repeats)
    # The greatest length, then the least start, then the least period.
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.expr("1000 * longest.length div -longest.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings; a deviation that 64 bits cannot hold is null."""
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").try_cast("long")
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrases.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_secret_scans,
        op3_pii,
        op4_decontamination,
        op5_lm_scoring,
        op6_quality_rules,
        op7_html_extraction,
        op8_packing,
        op9_language_id,
        op10_simhash,
        op11_periodic_runs,
        op12_whitening,
        op13_substring_dedup,
    )
}
#: Words of a text, in a list.
WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: The registered queries that SQL can express: records of pages by digests and the choice of the stored copy; runs by
#: joining equal six-word grams of a text, whose neighbours on a diagonal make stretches; windows by their count.
ORACLE = {
    "op1_warc": """
with p as (
  select page_id, url, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
), s as (
  select html, max(page_id) as first from p where payload_bytes >= 1000 group by html
)
select p.page_id, p.url, p.payload_bytes, sha1(p.html) as payload_digest,
  case when s.first is not null and p.page_id <> s.first then 'revisit' else 'response' end as record_type,
  case when s.first is not null and p.page_id <> s.first then s.first end as refers_to
from p left join s on p.html = s.html
""",
    "op11_periodic_runs": f"""
with d as (
  select row_number() over () as r, doc_id, len(w) as n, w, h from (
    select doc_id, {WORDS} as w,
      xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
        lambda crc, byte: list_reduce(range(8), lambda s, k: xor(s >> 1, 3988292384 * (s & 1)), xor(crc, byte)),
        4294967295), 4294967295) as h
    from documents)
), plan as (
  select r, case when h % 10 = 0 and n > 0 then (h // 10) % n end as a,
    case when h % 10 = 0 and n > 0 then 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) end as p from d
), given as (
  select r, unnest(range(len(w))) as i, unnest(w) as word from d
), t as (
  select g.r, g.i, o.word from given g join plan on plan.r = g.r
  join given o on o.r = g.r and o.i = case when g.i >= plan.a then plan.a + (g.i - plan.a) % plan.p else g.i end
), grams as (
  select r, i, md5(string_agg(word, ' ') over six) as gram, count(*) over six as size from t
  window six as (partition by r order by i rows between current row and 5 following)
), seeds as (
  select x.r, x.i, y.i - x.i as q from grams x join grams y on x.r = y.r and x.gram = y.gram and x.i < y.i
  where x.size = 6 and y.size = 6
), stretches as (
  select r, q, min(i) as s, count(*) + 5 as agree from (
    select *, i - row_number() over (partition by r, q order by i) as island from seeds) group by r, q, island
), found as (
  select r, s, agree + q as len, q from stretches where agree >= q and agree >= 12 - q
), runs as (
  select * from found f where not exists (
    select 1 from found o where o.r = f.r and o.q < f.q and f.q % o.q = 0 and o.s <= f.s and o.s + o.len >= f.s + f.len)
), best as (
  select r, count(*) as n_runs, first({{'s': s, 'len': len, 'q': q}} order by len desc, s, q) as b,
    string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as listed from runs group by r
), steps as (
  select r, i, sum(step) as step from (
    select r, s + q as i, 1 as step from runs union all select r, s + len, -1 from runs) group by r, i
), kept as (
  select t.r, t.i, t.word, coalesce(sum(steps.step) over (partition by t.r order by t.i), 0) = 0 as stays
  from t left join steps on steps.r = t.r and steps.i = t.i
), collapsed as (
  select r, string_agg(word, ' ' order by i) filter (stays) as text from kept group by r
)
select d.doc_id, coalesce(n_runs, 0) as n_runs, b.s as start, cast(b.len as bigint) as length, b.q as period,
  cast(1000 * b.len // b.q as bigint) as exponent_milli,
  sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(collapsed.text, '')) as collapsed_sha256
from d left join best on best.r = d.r left join collapsed on collapsed.r = d.r
""",
    "op13_substring_dedup": f"""
with d as (
  select row_number() over () as r, doc_id,
    {WORDS} as w from documents
), t as (
  select r, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from d
), p as (
  select r, i, md5(string_agg(word, ' ') over (partition by r order by i rows between current row and 34 following)) as words,
    count(*) over (partition by r order by i rows between current row and 34 following) as n from t
), k as (
  select r, i, count(*) over (partition by words) > 1 as twice from p where n = 35
), g as (
  select t.r, t.i, t.word, coalesce(max(cast(k.twice as int)) over (
    partition by t.r order by t.i rows between 34 preceding and current row), 0) = 1 as gone
  from t left join k on t.r = k.r and t.i = k.i
), s as (
  select r, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from g group by r
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(s.n_removed, 0) as n_removed, sha256(coalesce(s.kept, '')) as kept_sha256
from d left join s on d.r = s.r
""",
}
