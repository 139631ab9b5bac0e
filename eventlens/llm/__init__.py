"""Operators for large-scale training-data preparation.

Ten DataFrame operators (``pii``, ``near_dup``, ``mixing``, ``sharding``,
``toxicity``, ``lm_score``, ``fingerprint``, ``pieces``, ``ann``, ``licenses``)
and the queries that apply them to whole tables (``queries``).  Nothing else
in the package imports this subpackage.
"""
