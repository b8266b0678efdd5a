"""Registered queries of the subpackage: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mcrunstat.llm import decontaminate, licenses
from mcrunstat.llm.common import scratch, ship, table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from mcrunstat.llm import tokenfiles

    folder = scratch(spark, "tokens")
    tokenfiles.write(table(spark, sf_dir, "documents", "doc_id", "text"), folder,
                     public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenfiles.read(spark, folder, values=False)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.simhash import hex_digits, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, distance=4)
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"), units=licenses.UNITS)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.repeats import dedup

    return dedup(table(spark, sf_dir, "documents", "doc_id", "text"), length=400)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm import warc

    archive = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages", "page_id", "url", "html"), archive)
    found = warc.captures(warc.read(warc.index(spark, archive)))
    return found.select(F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long"), "url")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.pii import find, train

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return find(docs, train(docs))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = decontaminate.phrases(table(spark, sf_dir, "benchmark", "item_id", "text"))
    return decontaminate.digest(decontaminate.search(table(spark, sf_dir, "documents", "doc_id", "text"), known))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.mixing import mix_by_source

    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix_by_source(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.lm import crc_split, score, train

    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", crc_split(F.col("doc_id")))
    return score(docs, train(docs.filter("not held_out")), ("doc_id", "held_out"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.quality import judge, train

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return judge(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), shards=40, law="rows")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents", "lang", "text"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mcrunstat.llm.conversations import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def _with_code(query):
    return lambda spark, sf_dir: query(ship(spark), sf_dir)


QUERIES = {f.__name__: _with_code(f) for f in (
    op1_token_files, op2_simhash, op3_licenses, op4_suffix_dedup, op5_warc, op6_pii, op7_decontamination, op8_mixing,
    op9_lm_scoring, op10_quality, op11_sharding, op12_collocations, op13_conversations)}

#: DuckDB SQL of the queries that SQL expresses.
ORACLE: dict[str, str] = {
    "op3_licenses": licenses.oracle(),
    "op7_decontamination": decontaminate.oracle(),
    "op12_collocations": """
        WITH pieces AS (
            SELECT row_number() OVER () AS p, lang, ws FROM (
                SELECT coalesce(lang, 'und') AS lang, string_split_regex(unnest(string_split_regex(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\f\r]')), '[ \t]+') AS ws
                FROM documents WHERE text IS NOT NULL)
        ), words AS (
            SELECT p, lang, k, w FROM (SELECT p, lang, generate_subscripts(ws, 1) AS k, unnest(ws) AS w FROM pieces) WHERE w <> ''
        ), seen AS (
            SELECT lang, w AS w1, lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM words WINDOW s AS (PARTITION BY p ORDER BY k)
        ), f1 AS (SELECT lang, w1, count(*) AS f FROM seen GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY ALL),
        f2 AS (SELECT lang, w1, w2, count(*) AS f FROM seen WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM seen WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        cuts AS (
            SELECT f2.lang, w1 || ' ' || w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1 AS k
            FROM f2 JOIN f1 x USING (lang, w1) JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
            WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
              AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
            UNION ALL
            SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, x.f, y.f, 1
            FROM f3 JOIN f1 x USING (lang, w1) JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
            UNION ALL
            SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, x.f, y.f, 2
            FROM f3 JOIN f2 x USING (lang, w1, w2) JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3
        ), scored AS (
            SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, a ORDER BY score, k) = 1
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best JOIN n USING (lang)
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
        ), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
        SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to, url
        FROM p LEFT JOIN f ON p.d = f.d
    """,
}
