"""Operations of a training-data pipeline: tokenising, filtering, dedup,
mixing, fingerprinting and scoring of document tables.

Every operator takes a DataFrame and column names, selects only the columns it
needs under names of its own (so extra or clashing columns do no harm) and
returns a new DataFrame; ``queries.py`` wraps them as registered queries.
"""
