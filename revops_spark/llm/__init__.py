"""Training-data operators: packing, scoring, deduplication, search, licence scans.

Nothing else in the library imports this subpackage. `queries.py` registers
one `opN_<name>` query per operator; each operator module has a general
interface of its own.
"""
