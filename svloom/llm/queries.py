"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import chat, conversation_repair, decontaminate, html_text, mixing, near_dups, packing, periodic_runs, quality, quality_rules, secrets, substrings, url_filter

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_secrets": secrets.op2_secrets,
    "op3_filter_urls": url_filter.op3_filter_urls,
    "op4_near_duplicates": near_dups.op4_near_duplicates,
    "op5_format_chats": chat.op5_format_chats,
    "op6_quality": quality.op6_quality,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_html_text": html_text.op8_html_text,
    "op9_substrings": substrings.op9_substrings,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_repair_conversations": conversation_repair.op11_repair_conversations,
    "op12_pack": packing.op12_pack,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

SQL = {
    "op3_filter_urls": url_filter.OP3_SQL,
    "op5_format_chats": chat.OP5_SQL,
    "op9_substrings": substrings.OP9_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
}
