"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import decontaminate, near_dedup, nearest, packing, pii, preferences, secret_scan, span_hashes, spelling, substring_dedup, suffix_dedup, toxicity, whitening


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _listed(spans) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    rank = lambda x: F.array_position(F.array(*map(F.lit, secret_scan.KINDS)), x["kind"])
    every = F.array_sort(F.concat("base", "random"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise((rank(a) - rank(b)).cast("int")))
    return found.select("doc_id", *map(count, secret_scan.KINDS[:3]), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(every).alias("spans"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_windows(_documents(spark, sf_dir), window=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
windows as (select doc_id, i, array_to_string(ws[i:i + 19], ' ') k from (select doc_id, ws, unnest(range(1, len(ws) - 18)) i from w)),
ranked as (select doc_id, i, row_number() over (partition by k order by doc_id, i) n from windows),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 20)) p from ranked where n > 1)),
each as (select doc_id, unnest(ws) word, unnest(range(1, len(ws) + 1)) p from w),
kept as (select e.doc_id, string_agg(word, ' ' order by e.p) t, count(*) n from each e left join gone g on e.doc_id = g.doc_id and e.p = g.p where g.p is null group by e.doc_id)
select w.doc_id, cast(len(ws) as bigint) n_words, cast(len(ws) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256
from w left join kept on w.doc_id = kept.doc_id
"""


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir), words=2, percent=80)


OP3_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 1 then ws else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) g from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
l as (select a i, b o from e union all select b, a from e),
r(doc_id, c) as (select doc_id, doc_id from documents union select r.doc_id, l.o from r join l on l.i = r.c)
select d.doc_id, coalesce(any_value(n.n), 0) n_shingles, min(r.c) component_id, min(r.c) = d.doc_id kept
from documents d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on labels whose crc32(doc_id as text) mod 5 is not 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.train(docs, labels, usable=F.crc32(F.col("id").cast("string")) % 5 != 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    made = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    return made.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=decontaminate.WINDOW)


def op6_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


OP6_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) e from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
n as (select vec_id, e, sqrt(list_inner_product(e, e)) l from v),
s as (select q.vec_id query_id, c.vec_id vec_id, list_inner_product(q.e, c.e) / (q.l * c.l) score
      from n q join n c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) n from s)
select query_id, cast(n as integer) rank, vec_id, score from r where n <= 5
"""


def op7_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no preferences: each even conversation is chosen over the next odd one."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    made = preferences.format_preferences(turns, F.expr("conv_id div 2"), F.expr("conv_id % 2 = 0"))
    spans = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return made.select("pair_id", "n_common", "prompt", "chosen", "rejected", spans("chosen_spans").alias("chosen_mask"), spans("rejected_spans").alias("rejected_mask"))


OP7_SQL = r"""
with t as (select conv_id // 2 pair_id, conv_id % 2 = 0 side, turn, coalesce(role, '') role, coalesce(text, '') txt from conversations where conv_id is not null),
o as (select *, row_number() over (partition by pair_id, side order by turn nulls first, role, txt) k from t),
whole as (select pair_id from o group by pair_id having count(distinct side) = 2),
m as (select a.pair_id, a.k, (a.role = b.role and a.txt = b.txt) same from o a join o b on a.pair_id = b.pair_id and a.k = b.k and a.side and not b.side),
c as (select w.pair_id, coalesce((select min(k) - 1 from m where m.pair_id = w.pair_id and not same), (select count(*) from m where m.pair_id = w.pair_id)) n from whole w),
r as (select o.*, c.n, '<|' || role || '|>' || chr(10) head, txt || '<|end|>' body from o join c on o.pair_id = c.pair_id),
p as (select *, k <= n common, coalesce(sum(length(head) + length(body) + 1) over (partition by pair_id, side, k <= n order by k rows between unbounded preceding and 1 preceding), 0) pos from r)
select pair_id, cast(any_value(n) as bigint) n_common,
  coalesce(string_agg(head || body || chr(10), '' order by k) filter (where common and side), '') prompt,
  coalesce(string_agg(head || body || chr(10), '' order by k) filter (where not common and side), '') chosen,
  coalesce(string_agg(head || body || chr(10), '' order by k) filter (where not common and not side), '') rejected,
  coalesce(string_agg(cast(cast(pos + length(head) as bigint) as varchar) || ':' || cast(cast(pos + length(head) + length(body) as bigint) as varchar), ',' order by k) filter (where not common and side and role = 'assistant'), '') chosen_mask,
  coalesce(string_agg(cast(cast(pos + length(head) as bigint) as varchar) || ':' || cast(cast(pos + length(head) + length(body) as bigint) as varchar), ',' order by k) filter (where not common and not side and role = 'assistant'), '') rejected_mask
from p group by pair_id
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_strings(_documents(spark, sf_dir), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), tokenizer_path(), size=2048)


def pseudonym_key(spark: SparkSession) -> bytes:
    """The session's secret key; without one, a fixed key, which anyone can invert and which is for the test tables only."""
    return spark.conf.get("spark.tallyweave.pseudonym.key", "a key for the shared test tables").encode()


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymise(_documents(spark, sf_dir), pseudonym_key(spark))
    return made.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), _listed(F.col("found")).alias("spans"))


def op11_span_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_hashes.fingerprints(_documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


#: crc32 is reduced over bytes with the table of its polynomial; words are near that share a word, or a word and place, less one code point.
OP12_SQL = r"""
with recursive crc as (select list(c order by i) t from (select i, list_reduce(list_concat([i], range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c from range(256) x(i))),
runs as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) run from documents),
low as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run, count(*) k from runs group by all),
bytes as (select run, k, flatten(list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || run, ''), lambda x: case when ord(x) < 128 then [cast(ord(x) as bigint)] else [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] end)) b from low where length(run) >= 6),
hashed as (select run, k, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) h from bytes, crc),
made as (select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, k from hashed),
words as (select word, cast(sum(k) as bigint) n from made where length(word) >= 6 group by word having sum(k) >= 5),
less as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) d from (select word, n, unnest(range(1, length(word) + 1)) i from words)),
near as (select a.word, b.word other, b.n from less a join less b on a.d = b.d and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from less a join words b on a.d = b.word union select b.word, a.word, a.n from less a join words b on a.d = b.word),
best as (select word, count(*) n_near, max(n) m, arg_min(other, (-n, other)) o from near group by word),
forms as (select w.word, w.n, coalesce(n_near, 0) n_near, case when m >= 5 * w.n then o end form, case when m >= 5 * w.n then m end form_n from words w left join best b on b.word = w.word),
walk(word, reached, steps) as (select word, word, 0 from forms union all select walk.word, f.form, steps + 1 from walk join forms f on f.word = walk.reached where f.form is not null),
ends as (select word, arg_max(reached, steps) root from walk group by word)
select f.word, form, root, n, n_near, form_n from forms f join ends e on e.word = f.word
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16)


def queries() -> dict:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_near_dedup": op3_near_dedup,
        "op4_toxicity": op4_toxicity,
        "op5_decontaminate": op5_decontaminate,
        "op6_block_nearest": op6_block_nearest,
        "op7_preference_format": op7_preference_format,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_pii_pseudonyms": op10_pii_pseudonyms,
        "op11_span_fingerprints": op11_span_fingerprints,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": OP2_SQL,
        "op3_near_dedup": OP3_SQL,
        "op6_block_nearest": OP6_SQL,
        "op7_preference_format": OP7_SQL,
        "op12_spelling_variants": OP12_SQL,
    }
