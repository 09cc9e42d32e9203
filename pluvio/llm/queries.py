"""The registered queries of the operators, and their SQL where there is one.

Each query runs its operator with production parameters over a whole table
and derives the columns of its result from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import (binary, centroids, chat, exact_dedup, langid, mixing, packing, phrases, quality, secrets, simhash,
                        topk, warc)
from pluvio.llm.common import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    apart = F.coalesce(F.crc32(found["doc_id"].cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score", "rejected")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.identifier_dictionary(docs))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.spans(F.col("findings"), ("assign", "access", "hex")), 256).alias("base_sha256"),
        secrets.spans(F.col("findings")).alias("spans"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.read(pages, warc.write(pages), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, max_bits=3, shingle=3)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.described(table(spark, sf_dir, "documents").select("doc_id", "text"))
    scored = quality.score(rows, quality.fit(rows, table(spark, sf_dir, "labels"), x_col="x"), x_col="x")
    return scored.select("doc_id", quality.held_out(scored["doc_id"]).alias("held_out"), "score", "predicted")


def op9_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = binary.read(binary.write(docs))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose two texts hold the template's own control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    made = chat.conversations(rows.unionByName(odd))
    turns = chat.read_turns(F.col("formatted"))
    learned = F.array_join(chat.read_loss(F.col("formatted"), F.col("loss")), "")
    read = made.select(F.col("tree").alias("conv_id"), "formatted", turns.alias("turns"), learned.alias("learned"))
    said_by = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said_by, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, components=64, scale=64, seed=1)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.collocations(docs, max_words=4, min_count=30, top=2000, absorb_percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_mixing": op2_mixing,
    "op3_packing": op3_packing,
    "op4_secrets": op4_secrets,
    "op5_topk": op5_topk,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_binary": op9_binary,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_chat": op11_chat,
    "op12_centroids": op12_centroids,
    "op13_phrases": op13_phrases,
}


def _centroid_sql(k: int = 16, rounds: int = 3, components: int = 64) -> str:
    """Clustering around centroids: one group of CTEs a round."""
    each = f"range(1, {components + 1})"
    ctes = [f"""
        v as (
            select row_number() over () as n, vec_id, list_transform(embedding, lambda x:
                   cast(floor(64 * x::double) as bigint)) as e
            from embeddings
            where len(embedding) = {components}
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""", f"""
        c0 as (
            select row_number() over (order by sha256('1:' || vec_id), e) - 1 as cluster, e from v
            qualify cluster < {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""
        a{i} as (
            select n, min({{'distance': list_sum(list_transform({each}, lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))),
                            'cluster': c.cluster}}) as near
            from v, c{i} c group by n)""")
        if i < rounds:
            ctes.append(f"""
        s{i} as (
            select near.cluster as cluster, i, sum(e[i]) as s, count(*) as n
            from a{i} join v using (n), range(1, {components + 1}) r(i) group by all)""")
            ctes.append(f"""
        c{i + 1} as (
            select c.cluster, coalesce(m.e, c.e) as e from c{i} c left join (
                select cluster, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as e
                from s{i} group by cluster) m using (cluster))""")
    return f"""
        with {",".join(ctes)}
        select v.vec_id, cast(near.cluster as integer) as cluster, cast(near.distance as bigint) as distance,
               cast(sum(near.distance) over (partition by near.cluster) as bigint) as cluster_inertia,
               cast(sum(near.distance) over () as bigint) as inertia,
               sha256(array_to_string(c.e, ',')) as centroid_sha256
        from a{rounds} join v using (n) join c{rounds} c on c.cluster = near.cluster"""


ORACLE: dict[str, str] = {
    "op5_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
            where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
            from v q, v c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
        r as (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
        select query_id, cast(n as integer) as rank, vec_id, score from r where n <= 20""",
    "op6_warc": """
        with p as (
            select page_id, coalesce(html, '') as payload,
                   max(page_id) over (partition by coalesce(html, '')) as last from pages)
        select page_id, strlen(payload) as payload_bytes, sha1(payload) as payload_digest,
               case when again then 'revisit' else 'response' end as record_type, case when again then last end as refers_to
        from (select *, strlen(payload) >= 1000 and last is not null and (page_id is null or page_id < last) as again from p)""",
    "op10_exact_dedup": """
        select doc_id,
               max(doc_id) over (partition by coalesce(text, '')) as keep_id,
               count(*) over (partition by coalesce(text, '')) as group_size,
               row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents""",
    "op11_chat": r"""
        with c as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-7, 0, 'user', '\### Assistant: </turn> ok'),
                             (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
        e as (
            select *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') as body,
                   replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') as head
            from c),
        g as (
            select conv_id, count(*) as n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, sha256(text)) as turns,
                   coalesce(string_agg(text, '' order by turn nulls first, sha256(text))
                            filter (role = 'assistant'), '') as learned,
                   sum(length('### ' || head || ': ' || body || '</turn>' || chr(10))) as formatted
            from e group by conv_id)
        select conv_id, n_turns, sha256(turns) as turns_sha256, length(learned) as loss_chars,
               sha256(learned) as loss_sha256, cast(formatted as bigint) as formatted_chars
        from g""",
    "op12_centroids": _centroid_sql(),
    "op13_phrases": r"""
        with p as (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(text,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
            from documents where text is not null),
        w as (
            select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
        f as (
            select lang, k, g as ws, count(*) as a from (
                select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) as g
                from w, range(1, 5) t(k) where len(ws) >= k)
            group by all having count(*) >= 30),
        s as (
            select c.lang, c.ws, c.k, c.a, min({'score': 2000000::hugeint * c.a // (l.a + r.a), 'cut': cut,
                                                'l': l.a, 'r': r.a}) as least
            from f c, range(1, 4) t(cut), f l, f r
            where c.k > cut and l.lang = c.lang and l.ws = c.ws[1:cut] and r.lang = c.lang and r.ws = c.ws[cut + 1:]
            group by all),
        i as (
            select lang, ws[b:b + m - 1] as ws, max(a) as longer
            from s, range(2, 4) t(m), range(1, 4) u(b) where m < k and b + m - 1 <= k group by all),
        n as (select lang, sum(len(ws)) as n from w group by lang),
        d as (
            select s.lang, array_to_string(s.ws, ' ') as phrase, a, least.l as l, least.r as r, least.score as score
            from s left join i on i.lang = s.lang and i.ws = s.ws
            where longer is null or 100 * longer < 80 * a)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
               phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
        from d join n using (lang) qualify rank <= 2000""",
}
