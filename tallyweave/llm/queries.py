"""Registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import centroids, chat, exact, jaccard, merkle, packing, pieces, sharding, simhash, suffix, topk, toxicity, warc
from tallyweave.llm.common import table, text_or_empty


def warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.page_captures(table(spark, sf_dir, "pages"))
    revisit = F.col("record_type") == "revisit"
    return captures.select(
        "page_id", F.when(revisit, F.col("original_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("original_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        "record_type", F.when(revisit, F.col("original_page")).alias("refers_to"))


def perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = chat.rotate(table(spark, sf_dir, "conversations"))
    return rotated.select("conv_id", "speaker", F.size("messages").cast("long").alias("messages"),
                          F.size(F.filter("messages", lambda m: m["trained"])).cast("long").alias("trained"), "text", "mask")


def sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.sampled_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), seed=7).withColumnRenamed("key", "doc_id")


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix.without_repeats(table(spark, sf_dir, "documents"), length=50)
    return done.select("doc_id", *[F.col(f"_{name}").alias(name) for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


def held_out() -> Column:
    """The fold that no classifier learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = toxicity.scored(docs, toxicity.fit(docs, labels.filter(~held_out())))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(text_or_empty().cast("binary")))
    return sharding.shard_documents(docs, 40).select(
        "doc_id", F.col("_size").alias("size"), "text_crc32",
        F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.membership(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    claim = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.proofs(table(spark, sf_dir, "documents"), claim).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64, salt="3:")
    spelled = F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(spelled, 256).alias("centroid_sha256"))


_NORMAL = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

QUERIES = {
    "op1_warc_transactions": warc_transactions,
    "op2_perspective_rotation": perspective_rotation,
    "op3_sampled_pieces": sampled_pieces,
    "op4_jaccard_join": jaccard_join,
    "op5_kd_tree_top_k": kd_tree_top_k,
    "op6_best_fit_packing": best_fit_packing,
    "op7_suffix_array_dedup": suffix_array_dedup,
    "op8_compression_toxicity": compression_toxicity,
    "op9_histogram_sharding": histogram_sharding,
    "op10_exact_dedup": exact_dedup,
    "op11_simhash_near_dedup": simhash_near_dedup,
    "op12_merkle_manifest": merkle_manifest,
    "op13_centroid_clustering": centroid_clustering,
}

_BASE32 = " || ".join(
    f"substr('{warc.BASE32}', cast((cast('0x' || substr(sha, {at}, 5) as bigint) >> {shift}) & 31 as int) + 1, 1)"
    for at in range(1, 40, 5) for shift in (15, 10, 5, 0))



def _crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text, four bits at a time; the table of sixteen follows from the polynomial."""
    table = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    nibbles = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c) & 15, ascii(c) >> 4]))"
    step = f"xor(c >> 4, {table}[cast(xor(c, x) & 15 as int) + 1])"
    return f"xor(list_reduce(list_transform({nibbles}, lambda x: cast(x as bigint)), lambda c, x: {step}, cast(4294967295 as bigint)), 4294967295)"


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """Trees of three: ``{name}_l`` has the nodes (tree, i, n, h) of level l, where a tree of one node rises unchanged."""
    out = [f"{name}_0 as materialized ({leaves})"]
    for l in range(1, levels + 1):
        out.append(f"""{name}_{l} as materialized (
            select tree, i // 3 as i, any_value((n + 2) // 3) as n, case when any_value(n) = 1 then min(h) else sha256(string_agg(h, '' order by i)) end as h
            from {name}_{l - 1} group by tree, i // 3)""")
    return ",\n".join(out)


def _climb_sql(name: str, start: str, levels: int) -> str:
    """From ``{name}_up_0`` (row, tree, i, own, proof) up the levels: the digest folded so far and the siblings met."""
    out = [f"{name}_up_0 as materialized ({start})"]
    for l in range(levels):
        out.append(f"""{name}_up_{l + 1} as materialized (
            select u.row, any_value(u.tree) as tree, any_value(u.i // 3) as i,
                   case when any_value(s.n) = 1 then any_value(u.own) else sha256(string_agg(case when s.i = u.i then u.own else s.h end, '' order by s.i)) end as own,
                   any_value(u.proof) || coalesce(string_agg(s.h, '' order by s.i) filter (s.i <> u.i), '') as proof
            from {name}_up_{l} u join {name}_{l} s on s.tree = u.tree and s.i // 3 = u.i // 3 group by u.row)""")
    return ",\n".join(out)


def _merkle_sql(levels: int = 12, over: int = 8) -> str:
    """For at most 3 ** levels documents of a source, and 3 ** over sources."""
    def field(x: str) -> str:
        return f"coalesce(strlen(cast({x} as varchar)) || ':' || {x}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars')))} || {field(text)})"

    clean = "replace(text, chr(10), '')"
    return f"""
        with leaves as materialized (
            select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n,
                   row_number() over () as row
            from (select doc_id, case when source is null then '' else '=' || source end as tree, {leaf('text')} as leaf,
                         case when coalesce({_crc32_sql('cast(doc_id as varchar)')} % 2 = 0, false) then {leaf(clean)} else {leaf('text')} end as claim
                  from documents)),
        {_tree_sql('d', 'select tree, i, n, leaf as h from leaves', levels)},
        subs as materialized (select tree, h, row_number() over (order by tree) - 1 as i, count(*) over () as n from d_{levels}),
        {_tree_sql('s', "select '' as tree, i, n, h from subs", over)},
        {_climb_sql('d', "select row, tree, i, claim as own, '' as proof from leaves", levels)},
        {_climb_sql('s', f"select u.row, '' as tree, subs.i, u.own, u.proof from d_up_{levels} u join subs using (tree)", over)}
        select doc_id, leaf, subs.h as subroot, s.h as root, sha256(u.proof) as proof_sha256, u.own as folded_root, u.own = s.h as verified
        from leaves join subs using (tree) join s_up_{over} u on u.row = leaves.row cross join s_{over} s
    """


def _centroid_sql(k: int = 8, rounds: int = 10) -> str:
    squared = "list_sum(list_transform(list_zip(point, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near_{r} as materialized (
            select row, any_value(vec_id) as vec_id, any_value(point) as point, min(d) as distance, arg_min(cluster, (d, cluster)) as cluster
            from (select row, vec_id, point, cluster, cast({squared} as bigint) as d from points, cents_{r}) group by row)""")
        if r < rounds:
            steps.append(f"""cents_{r + 1} as materialized (
                select cluster, coalesce(any_value(mean), any_value(c)) as c
                from cents_{r} left join (
                    select cluster, list(cast(m as bigint) order by axis) as mean
                    from (select cluster, axis, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m
                          from (select cluster, unnest(point) as x, unnest(range(1, 65)) as axis from near_{r}) group by cluster, axis)
                    group by cluster) using (cluster)
                group by cluster)""")
    return f"""
        with points as materialized (
            select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as point
            from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        cents_0 as materialized (
            select row_number() over (order by sha256('3:' || vec_id) nulls last, point) - 1 as cluster, point as c from points qualify cluster < {k}),
        {', '.join(steps)}
        select vec_id, cast(cluster as int) as cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
               cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
        from near_{rounds} join cents_{rounds} using (cluster)
    """


_WORDS = "regexp_extract_all(normal, '[^\\x20\\x09-\\x0D]+')"


def _jaccard_sql(words: int, num: int, den: int) -> str:
    """Sets of shingles, pairs counted over shared shingles, and the closure of the links."""
    return f"""
        with recursive docs as materialized (
            select row_number() over () as row, doc_id, {_WORDS} as words from (select doc_id, {_NORMAL} as normal from documents)),
        shingles as materialized (
            select distinct row, array_to_string(words[nth:nth + {words - 1}], ' ') as shingle
            from (select row, words, unnest(range(1, greatest(len(words) - {words - 2}, least(len(words), 1) + 1))) as nth from docs)),
        sizes as materialized (select row, count(*) as n from shingles group by row),
        pairs as materialized (
            select a.row as x, b.row as y, count(*) as n from shingles a join shingles b on a.shingle = b.shingle and a.row < b.row group by a.row, b.row),
        close as materialized (
            select x, y from pairs p join sizes sx on sx.row = x join sizes sy on sy.row = y where {den} * p.n >= {num} * (sx.n + sy.n - p.n)),
        links as materialized (select x, y from close union all select y, x from close),
        reached as (select row as x, row as y from docs union select r.x, l.y from reached r join links l on r.y = l.x),
        least as (select r.x, min(d.doc_id) as component_id from reached r join docs d on d.row = r.y group by r.x)
        select doc_id, coalesce(n, 0) as n_shingles, component_id from docs left join sizes using (row) join least on x = docs.row
    """


def _repeats_sql(length: int) -> str:
    """Bytes as pairs of hexadecimal digits; every string of ``length`` bytes with the smallest id that has it."""
    return f"""
        with docs as materialized (
            select row_number() over () as row, doc_id, coalesce(doc_id, 9223372036854775807) as id, strlen(coalesce(text, '')) as n,
                   hex(encode(coalesce(text, ''))) as digits from documents),
        strings as (select row, id, place, substr(digits, 2 * place + 1, {2 * length}) as s from (
            select *, unnest(range(n - {length - 1})) as place from docs where n >= {length})),
        held as (select row, place from (select row, id, place, min(id) over (partition by s) as least from strings) where least < id),
        marked as (select row, place, coalesce(place > lag(place) over (partition by row order by place) + {length}, true) as opens from held),
        runs as (select row, place, sum(opens::int) over (partition by row order by place) as run from marked),
        spans as (select row, min(place) as first, max(place) + {length} as past from runs group by row, run),
        parts as (
            select row, first, past, coalesce(lag(past) over (partition by row order by first), 0) as since,
                   lead(first) over (partition by row order by first) is null as last
            from spans),
        cut as (
            select row, sum(past - first) as removed, count(*) as spans,
                   string_agg(substr(digits, 2 * since + 1, 2 * (first - since)) || case when last then substr(digits, 2 * past + 1) else '' end, '' order by first) as kept
            from parts join docs using (row) group by row)
        select doc_id, n as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans,
               sha256(unhex(coalesce(kept, digits))) as kept_sha256
        from docs left join cut using (row)
    """


ORACLES = {
    "op4_jaccard_join": _jaccard_sql(words=4, num=85, den=100),
    "op7_suffix_array_dedup": _repeats_sql(length=50),
    "op1_warc_transactions": f"""
        select page_id, strlen(payload) as payload_bytes, {_BASE32} as payload_digest,
               case when nth = 1 then 'response' else 'revisit' end as record_type,
               case when nth > 1 then first end as refers_to
        from (select page_id, payload, sha1(payload) as sha, row_number() over (partition by payload order by page_id) as nth,
                     first_value(page_id) over (partition by payload order by page_id) as first
              from (select page_id, coalesce(html, '') as payload from pages))
    """,
    "op2_perspective_rotation": f"""
        with turns as (
            select distinct conv_id, turn, coalesce(role, 'unknown') as role, replace(coalesce(text, ''), '<|', '<​|') as content
            from conversations where conv_id is not null),
        speakers as (select distinct conv_id, role as speaker from turns where role <> 'system'),
        said as (
            select conv_id, speaker, turn, role, content, role = speaker as trained,
                   '{chat.OPEN}' || case when role = speaker then 'assistant' when role = 'system' then 'system'
                                         else 'user name=' || role end || chr(10) as head
            from turns join speakers using (conv_id)),
        placed as (
            select *, coalesce(sum(length(head) + length(content) + {len(chat.CLOSE) + 1}) over (
                       partition by conv_id, speaker order by turn nulls first, role, content
                       rows between unbounded preceding and 1 preceding), 0) + length(head) as start
            from said)
        select conv_id, speaker, count(*) as messages, count(*) filter (trained) as trained,
               string_agg(head || content || '{chat.CLOSE}' || chr(10), '' order by turn nulls first, role, content) as text,
               string_agg(cast(start as bigint) || '-' || cast(start + length(content) + {len(chat.CLOSE)} as bigint), ';'
                          order by turn nulls first, role, content) filter (trained) as mask
        from placed group by conv_id, speaker
    """,
    "op5_kd_tree_top_k": """
        with whole as (
            select vec_id, list_transform(min(embedding), lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and vec_id is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            group by vec_id),
        scored as (
            select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
            from whole q join whole c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v))
        select query_id, cast(rank as int) as rank, vec_id, score
        from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
        where rank <= 10
    """,
    "op12_merkle_manifest": _merkle_sql(),
    "op13_centroid_clustering": _centroid_sql(),
    "op10_exact_dedup": f"""
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               row_number() over (partition by normal order by doc_id desc) = 1 as kept, sha256(normal) as text_sha256
        from (select doc_id, {_NORMAL} as normal from documents)
        window same as (partition by normal)
    """,
}
