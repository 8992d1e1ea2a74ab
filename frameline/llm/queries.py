"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers

from frameline.llm import bpe, chat, decontaminate, minhash, omh, pieces, secrets, spans, spelling, substrings, toxicity, urls, warc
from frameline.llm.common import read


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_warc_dictionary(spark, sf_dir):
    back = warc.round_trip(read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_minhash_fingerprints(spark, sf_dir):
    return minhash.edited_fingerprints(read(spark, sf_dir, "documents"))


def op3_bpe_transducer(spark, sf_dir):
    return bpe.encode_decode(read(spark, sf_dir, "documents"), TOKENIZER)


def op4_structural_secrets(spark, sf_dir):
    return secrets.scan(read(spark, sf_dir, "documents"))


def op5_ftrl_toxicity(spark, sf_dir):
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_url_reputation(spark, sf_dir):
    judged = urls.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_block_max_wand(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_block_anchors(spark, sf_dir):
    return substrings.digest(substrings.repeats(read(spark, sf_dir, "documents")))


def op9_chat_round_trip(spark, sf_dir):
    turns = chat.with_hostile_conversation(read(spark, sf_dir, "conversations"))
    return chat.digest(chat.format_conversations(turns))


def op10_order_minhash(spark, sf_dir):
    return omh.near_classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op11_spelling_partenum(spark, sf_dir):
    return spelling.variants(read(spark, sf_dir, "documents"), every=97)


def op12_piece_backtracking(spark, sf_dir):
    return pieces.encode_decode(read(spark, sf_dir, "documents"), PIECES)


def op13_token_spans(spark, sf_dir):
    return spans.align_tokens(read(spark, sf_dir, "documents"), BYTES, PIECES)


QUERIES = {q.__name__: q for q in (op1_warc_dictionary, op2_minhash_fingerprints, op3_bpe_transducer, op4_structural_secrets, op5_ftrl_toxicity, op6_url_reputation, op7_block_max_wand, op8_block_anchors, op9_chat_round_trip, op10_order_minhash, op11_spelling_partenum, op12_piece_backtracking, op13_token_spans)}
SQL = {"op1_warc_dictionary": warc.SQL, "op6_url_reputation": urls.SQL, "op8_block_anchors": substrings.SQL, "op9_chat_round_trip": chat.SQL}
