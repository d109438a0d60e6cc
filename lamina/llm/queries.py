"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from lamina.llm import chat, licenses, quality
from lamina.llm.chat import op6_chat_formatting
from lamina.llm.fingerprints import op5_document_fingerprints
from lamina.llm.html_extract import op2_html_extraction
from lamina.llm.licenses import op4_license_scans
from lamina.llm.mixing import op9_mixing_sources
from lamina.llm.neardup import op10_simhash_near_dedup
from lamina.llm.packing import op1_best_fit_packing
from lamina.llm.pii import op7_pii_boosted
from lamina.llm.quality import op3_quality_rules
from lamina.llm.secrets_scan import op8_secret_scans

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_html_extraction,
        op3_quality_rules,
        op4_license_scans,
        op5_document_fingerprints,
        op6_chat_formatting,
        op7_pii_boosted,
        op8_secret_scans,
        op9_mixing_sources,
        op10_simhash_near_dedup,
    )
}
ORACLES: dict[str, str] = {"op3_quality_rules": quality.ORACLE_SQL, "op4_license_scans": licenses.ORACLE_SQL, "op6_chat_formatting": chat.ORACLE_SQL}
