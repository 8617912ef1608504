"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.session import read_table


def op1_html(spark, sf_dir):
    from corpusmill.llm.htmltext import main_texts

    return main_texts(read_table(spark, sf_dir, "pages"))


def op2_lines(spark, sf_dir):
    from corpusmill.llm.linededup import dedup_lines

    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_lines", "n_removed")


#: Documents whose crc32(doc_id) mod 4 is this are held out: no label of theirs is learnt from.
HELD_OUT = 2


def held_out(id_col="doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def quality_model(spark, docs, sf_dir):
    from corpusmill.llm.quality import fit

    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    return fit(docs, labels)


def op3_quality(spark, sf_dir):
    from corpusmill.llm.quality import score

    docs = read_table(spark, sf_dir, "documents")
    out = score(docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_simhash(spark, sf_dir):
    from corpusmill.llm.simhash import near_groups

    return near_groups(read_table(spark, sf_dir, "documents"), k=3, distance=2)


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark, sf_dir):
    from corpusmill.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), vocabulary=vocabulary(), capacity=4096, end_id=2)


def op6_superkmers(spark, sf_dir):
    from corpusmill.llm.superkmers import dedup_windows

    out = dedup_windows(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_piecewise(spark, sf_dir):
    from corpusmill.llm.piecewise import compare_with_next

    out = compare_with_next(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", "near_edited", "near_next")


def op8_topk(spark, sf_dir):
    from corpusmill.llm.topk import top_k

    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op9_suffixes(spark, sf_dir):
    from corpusmill.llm.suffixes import dedup_substrings

    out = dedup_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_mixing(spark, sf_dir):
    from corpusmill.llm.mixing import mix_sources, taken

    return taken(*mix_sources(read_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, repeats=2))


def op11_toxicity(spark, sf_dir):
    from corpusmill.llm.toxicity import fit, score

    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels").where(~held_out()))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op12_crosstoken(spark, sf_dir):
    import public_tokenizers

    from corpusmill.llm.crosstoken import cross_align

    out = cross_align(read_table(spark, sf_dir, "documents"), path_a=public_tokenizers.path("byte_bpe_50k.json"),
                      path_b=public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


def op13_merkle(spark, sf_dir):
    from corpusmill.llm.merkle import manifest

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = manifest(read_table(spark, sf_dir, "documents"), fields=("doc_id", "source", "lang", "n_chars", "text"), part_col="lang",
                   changed={"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def queries() -> dict:
    return {"op1_html": op1_html, "op2_lines": op2_lines, "op3_quality": op3_quality, "op4_simhash": op4_simhash, "op5_packing": op5_packing,
            "op6_superkmers": op6_superkmers, "op7_piecewise": op7_piecewise, "op8_topk": op8_topk, "op9_suffixes": op9_suffixes,
            "op10_mixing": op10_mixing, "op11_toxicity": op11_toxicity, "op12_crosstoken": op12_crosstoken,
            "op13_merkle": op13_merkle}


def oracle_sql() -> dict[str, str]:
    from corpusmill.llm import oracle

    return oracle.SQL
