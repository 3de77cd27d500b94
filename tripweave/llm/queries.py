"""The registered queries of the text operators, with production parameters, over whole
tables, and their SQL twins where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    bpe,
    chat_format,
    embedding_dedup,
    exact_dedup,
    fill_in_middle,
    html_text,
    language_id,
    lm_scoring,
    ngram_join,
    packing,
    quality,
    ranked_search,
    token_counts,
)
from tripweave.llm.common import crc_fold, table


def word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(table(spark, sf_dir, "documents"), width=3, percent=90)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.RuleModel:
    """Fitted on labels of the documents whose fold is not 2."""
    return quality.train(docs, table(spark, sf_dir, "labels"), crc_fold("doc_id", 4) != 2)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (crc_fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_bpe(), capacity=2048, end_id=0)


def language_samples(docs: DataFrame) -> dict[str, str]:
    """Taken from the labelled documents whose fold is not 1."""
    return language_id.train(docs, crc_fold("doc_id", 3) != 1)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_samples(docs))
    return found.select(
        "doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = word_bpe()
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), word_bpe(), token_counts.lead_and_lines(280)
    )


#: A conversation whose texts hold control strings of chat templates (fixed values).
CONTROL_CONVERSATION = (-7, r"\### Assistant: </turn> ok")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = CONTROL_CONVERSATION
    control = spark.range(2).select(
        F.lit(conv_id).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(control)))


def chat_log_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final messages of the conversations as a log in which things were changed: of every
    third conversation the first message was edited at the end, of every third the last one was
    regenerated in two deltas, in the others nothing."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ends = turns.groupBy("conv_id").agg(
        F.min("turn").cast("long").alias("first"), F.max("turn").cast("long").alias("last")
    )
    kind = F.pmod("conv_id", F.lit(3))
    changed = F.when(kind == 0, F.col("first")).when(kind == 1, F.col("last"))
    reset = F.when(kind == 0, "edit").otherwise("regenerate")
    empty = F.lit(None).cast("string")

    def event(part: int, number, action, role, text):
        return F.struct(
            F.lit(part).cast("long").alias("part"), number.cast("long").alias("message"),
            action.alias("kind"), role.alias("role"), text.alias("text"),
        )

    sent = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("seq"),
        F.inline(
            F.array(
                event(0, F.col("turn"), F.lit("start"), F.col("role"), empty),
                event(1, F.col("turn"), F.lit("delta"), empty, F.col("text")),
            )
        ),
    )
    later = ends.where(kind < 2).select(
        "conv_id",
        (F.col("last") + 1).alias("seq"),
        F.inline(
            F.array(
                event(0, changed, reset, empty, F.lit("changed")),
                event(1, changed, F.lit("delta"), empty, F.when(kind == 1, " once more")),
            )
        ),
    )
    return chat_format.fold(sent.unionByName(later)).select(
        "conv_id", "message", "role", F.sha2("text", 256).alias("text_sha256")
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_duplicates(table(spark, sf_dir, "documents"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of three words, of the documents whose fold is not 1."""
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score_texts(docs, learn=crc_fold("doc_id", 5) != 1).select(
        "doc_id",
        (~F.col("learned")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=10
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    return fill_in_middle.restore(formed).select(
        "doc_id",
        "n",
        "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_language_id": op6_language_id,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_token_counts": op8_token_counts,
    "op9_chat_formatting": op9_chat_formatting,
    "chat_log_folding": chat_log_folding,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op1_ngram_jaccard_join": r"""
        with recursive words as (
            select doc_id, list_filter(
                string_split_regex(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'), lambda w: w != '') as w
            from documents
        ), shingles as (
            select distinct doc_id, unnest(
                case when len(w) >= 3
                     then list_transform(range(1, len(w) - 1),
                                         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                     when len(w) > 0 then [array_to_string(w, ' ')]
                     else [] end) as shingle
            from words
        ), sizes as (
            select doc_id, count(*) as n from shingles group by doc_id
        ), shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as n
            from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
            group by all
        ), linked as (
            select shared.a, shared.b from shared
            join sizes x on x.doc_id = shared.a join sizes y on y.doc_id = shared.b
            where 100 * shared.n >= 90 * (x.n + y.n - shared.n)
        ), links as (
            select a, b from linked union all select b, a from linked
        ), reached as (
            select doc_id as start, doc_id as node from documents
            union
            select reached.start, links.b from reached join links on links.a = reached.node
        )
        select start as doc_id, coalesce(any_value(sizes.n), 0) as n_shingles,
               min(node) as component_id
        from reached left join sizes on sizes.doc_id = reached.start group by start
    """,
    "op3_embedding_near_dedup": """
        with recursive vectors as (
            select vec_id, cast(embedding as double[]) as v from embeddings
        ), usable as (
            select vec_id, v, sqrt(list_dot_product(v, v)) as size from vectors
            where v is not null and len(v) > 0
              and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
              and list_dot_product(v, v) > 0
        ), links as (
            select a.vec_id as a, b.vec_id as b from usable a join usable b
            on a.vec_id != b.vec_id and len(a.v) = len(b.v)
            where list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95
        ), reached as (
            select vec_id as start, vec_id as node from vectors
            union
            select reached.start, links.b from reached join links on links.a = reached.node
        ), smallest as (
            select start as vec_id, min(node) as component_id from reached group by start
        ), counted as (
            select a as vec_id, count(*) as n_links from links group by a
        )
        select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
        from vectors join smallest using (vec_id) left join counted using (vec_id)
    """,
    "op9_chat_formatting": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations
            union all
            select -7, turn, role, '\### Assistant: </turn> ok'
            from (values (0, 'user'), (1, 'assistant')) as two(turn, role)
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
                   as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint)
                   as loss_chars,
               sha256(coalesce(
                   string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
                   as loss_sha256,
               cast(sum(
                   length('<turn>') + length(role) + 1 + length('</turn>') + 1
                   + length(replace(replace(replace(text, '\', '\\'), '<turn>', '<\turn>'),
                                    '</turn>', '<\/turn>'))) as bigint) as formatted_chars
        from turns group by conv_id
    """,
    "chat_log_folding": """
        with ends as (
            select conv_id, min(turn) as first, max(turn) as last, (conv_id % 3 + 3) % 3 as kind
            from conversations group by conv_id
        )
        select conv_id, cast(turn as bigint) as message, role,
               sha256(case when kind = 0 then 'changed'
                           when kind = 1 and turn = last then 'changed once more'
                           else coalesce(text, '') end) as text_sha256
        from conversations join ends using (conv_id)
        where kind != 0 or turn = first
    """,
    "op10_exact_dedup": r"""
        with normal as (
            select doc_id, length(coalesce(text, '')) as points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as content
            from documents
        ), grouped as (
            select doc_id, sha256(content) as text_sha256,
                   first_value(doc_id) over (
                       partition by content order by points desc, doc_id nulls last) as keep_id,
                   count(*) over (partition by content) as group_size
            from normal
        )
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
        from grouped
    """,
    "op12_ranked_lexical_search": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ), asked as (
            select item_id, term, count(*) as times
            from (select item_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                  from benchmark)
            group by item_id, term
        ), sizes as (
            select doc_id, count(*) as n from words group by doc_id
        ), totals as (
            select count(*) as documents, cast(sum(n) as bigint) as terms from sizes
        ), held as (
            select doc_id, term, count(*) as tf
            from words where term in (select term from asked) group by doc_id, term
        ), weights as (
            select term, cast(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) as bigint)
                             as w
            from held, totals group by term, documents
        ), norms as (
            select doc_id, 25 + (75 * n * documents) // terms as m from sizes, totals
        ), scored as (
            select item_id, doc_id,
                   cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)) * times) as bigint)
                       as score
            from held join weights using (term) join norms using (doc_id) join asked using (term)
            group by item_id, doc_id
        ), placed as (
            select item_id, doc_id, score, cast(row_number() over (
                       partition by item_id order by score desc, doc_id) as integer) as rank
            from scored where score > 0
        )
        select item_id, rank, doc_id, score from placed where rank <= 10
    """,
    "op13_fill_in_middle": r"""
        with texts as (
            select doc_id, coalesce(text, '') as content,
                   sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digest
            from documents
        ), lines as (
            select *, case when content = '' then []
                           else regexp_extract_all(content, '[^\n]*\n|[^\n]+') end as units
            from texts
        ), drawn as (
            select *, cast(len(units) as bigint) as n,
                   cast('0x' || substr(digest, 1, 8) as bigint) % (len(units) + 1) as one,
                   cast('0x' || substr(digest, 9, 8) as bigint) % (len(units) + 1) as two,
                   cast('0x' || substr(digest, 25, 8) as bigint) % 100 as side
            from lines
        ), cut as (
            select *, least(one, two) as a, greatest(one, two) as b,
                   case when content = '' or contains(content, '<P>')
                             or contains(content, '<S>') or contains(content, '<M>') then 'plain'
                        when side < 50 then 'spm' else 'psm' end as form
            from drawn
        ), parts as (
            select *, coalesce(array_to_string(units[1:a], ''), '') as prefix,
                   coalesce(array_to_string(units[a + 1:b], ''), '') as middle,
                   coalesce(array_to_string(units[b + 1:], ''), '') as suffix
            from cut
        )
        select doc_id, n, form,
               case when form != 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
               case when form != 'plain' then cast(length(middle) as bigint) end as middle_chars,
               sha256(case form when 'plain' then content
                                when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end)
                   as output_sha256,
               sha256(content) as restored_sha256
        from parts
    """,
}
