"""The queries of this subpackage, by name, and their SQL where there is one."""

from __future__ import annotations

from quillspark.llm.decontaminate import op8_decontamination
from quillspark.llm.langid import op4_langid
from quillspark.llm.media import op1_flac
from quillspark.llm.pii import op5_pii
from quillspark.llm.quality import op9_quality
from quillspark.llm.secrets import SQL as SECRETS_SQL
from quillspark.llm.secrets import op3_secrets
from quillspark.llm.sentencepieces import op7_sentencepiece
from quillspark.llm.simhash import op2_simhash
from quillspark.llm.token_files import op6_orc
from quillspark.llm.toxicity import op10_toxicity


def queries() -> dict:
    return {"op1_flac": op1_flac, "op2_simhash": op2_simhash, "op3_secrets": op3_secrets, "op4_langid": op4_langid, "op5_pii": op5_pii, "op6_orc": op6_orc, "op7_sentencepiece": op7_sentencepiece, "op8_decontamination": op8_decontamination, "op9_quality": op9_quality, "op10_toxicity": op10_toxicity}


def oracle_sql() -> dict[str, str]:
    return {"op3_secrets": SECRETS_SQL}
