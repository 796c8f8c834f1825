"""Training-data operators: deduplication, language identification, licence scans, packing,
decontamination, chat formatting, sharding and vector near-duplicates.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries only when it can be imported.
"""
