from tessera.functions.scalars import (
    TARGET_RULES, COUNTRY_RULES, map_values, none_to_pass, rule_classify,
    classify_target, keyword_country, whitelist_other, zero_guard, parse_list_literal,
)
from tessera.functions.hashing import hash_u32, hash_unit, hash_u32_sql, hash_unit_sql

__all__ = [
    "TARGET_RULES", "COUNTRY_RULES", "map_values", "none_to_pass", "rule_classify",
    "classify_target", "keyword_country", "whitelist_other", "zero_guard",
    "parse_list_literal", "hash_u32", "hash_unit", "hash_u32_sql", "hash_unit_sql",
]
