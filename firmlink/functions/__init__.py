"""Column builders: every function here returns a native Spark ``Column``
(no Python in the row path) except :mod:`firmlink.functions.similarity`,
which holds the one vectorised (Arrow) UDF of the engine."""

from firmlink.functions.text import block_key, norm_name, or_chain, precedence, py_strip
from firmlink.functions.url import row_hash, url_domain, url_hash
from firmlink.functions.dates import norm_date
from firmlink.functions.html import (
    decode_entities,
    extract_company_fields,
    html_industry,
    html_meta_name,
    html_org_name,
    html_title_name,
)

__all__ = [
    "block_key", "norm_name", "or_chain", "precedence", "py_strip",
    "row_hash", "url_domain", "url_hash", "norm_date",
    "decode_entities", "extract_company_fields", "html_industry", "html_meta_name",
    "html_org_name", "html_title_name",
]
