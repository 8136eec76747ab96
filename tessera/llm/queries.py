"""The queries of the corpus operators, over whole tables."""

from __future__ import annotations

from .common import read_table


def op1_decontamination(spark, sf_dir):
    from .decontamination import decontaminate

    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")


def op2_quality_rules(spark, sf_dir):
    from .quality_rules import labelled_sample, learn_rules, quality_verdicts

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(labelled_sample(docs, read_table(spark, sf_dir, "labels")))
    out = quality_verdicts(docs, rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op3_language_id(spark, sf_dir):
    from pyspark.sql import functions as F

    from .language_id import identify_language, train_prototypes

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))
    prototypes = train_prototypes(docs.where(~F.col("held_out")))
    return identify_language(docs, prototypes, keep=("doc_id", "held_out"))


def op4_token_counts(spark, sf_dir):
    from .token_counts import token_counts

    return token_counts(read_table(spark, sf_dir, "documents"))


def op5_token_output(spark, sf_dir):
    from .token_output import token_round_trip

    return token_round_trip(read_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark, sf_dir):
    from .suffix_dedup import remove_repeats

    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_chat_format(spark, sf_dir):
    from .chat_format import render, turns_of_maximal

    return render(turns_of_maximal(read_table(spark, sf_dir, "conversations")))


def op8_ngram_jaccard(spark, sf_dir):
    from .jaccard_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark, sf_dir):
    from pyspark.sql import functions as F

    from .secrets import scan, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan(docs, train(docs))
    return out.select("doc_id", F.size("found").cast("long").alias("n_candidates"), F.size("secrets").cast("long").alias("n_secrets"), F.sha2(F.array_join("secrets", ","), 256).alias("secrets_sha256"))


def op10_best_fit_packing(spark, sf_dir):
    from .packing import best_fit_packing

    return best_fit_packing(read_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    from pyspark.sql import functions as F

    from .prefix_trie import prefix_trie

    conv = F.col("conv_id")
    return prefix_trie(read_table(spark, sf_dir, "conversations"), conv - conv % 100, F.crc32(conv.cast("string")) % 6, 5)


def op12_personal_data(spark, sf_dir):
    from .pii import find_personal_data

    return find_personal_data(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    from pyspark.sql import functions as F

    from .merkle import merkle_manifest

    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle_manifest(read_table(spark, sf_dir, "documents"), tampered=tampered).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return SQL
