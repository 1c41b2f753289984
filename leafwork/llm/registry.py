"""The queries of this subpackage and the SQL of those that SQL can express."""

from leafwork.llm.jaccard import op8_jaccard
from leafwork.llm.language import op6_language
from leafwork.llm.licenses import op5_licenses
from leafwork.llm.mixing import OP7_SQL, op7_mixing
from leafwork.llm.packing import op1_pack
from leafwork.llm.quality import OP3_SQL, op3_quality
from leafwork.llm.secrets import op2_secrets
from leafwork.llm.suffixes import op9_suffixes
from leafwork.llm.topk import OP4_SQL, op4_topk
from leafwork.llm.warc import op10_warc

QUERIES = {
    "op1_pack": op1_pack,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_topk": op4_topk,
    "op5_licenses": op5_licenses,
    "op6_language": op6_language,
    "op7_mixing": op7_mixing,
    "op8_jaccard": op8_jaccard,
    "op9_suffixes": op9_suffixes,
    "op10_warc": op10_warc,
}
ORACLES = {
    "op3_quality": OP3_SQL,
    "op4_topk": OP4_SQL,
    "op7_mixing": OP7_SQL,
}
