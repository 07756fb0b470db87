from .domains import normalize_domain, reverse_domain, unreverse_domain, url_host
from .labels import category_title, fmt_fixed, fmt_percent, links_to_label, yes_no
from .scoring import authority_percentile, competitor_count, keyword_category, opportunity_score

__all__ = [
    "normalize_domain", "reverse_domain", "unreverse_domain", "url_host",
    "category_title", "fmt_fixed", "fmt_percent", "links_to_label", "yes_no",
    "authority_percentile", "competitor_count", "keyword_category", "opportunity_score",
]
