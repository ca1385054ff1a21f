"""Operations of a training-data pipeline (token counts, decontamination,
language identification, WARC, deduplication, extraction, packing).

Nothing else in the library imports this subpackage. On a cluster the package
is shipped with the job (``--py-files``), as the tasks of the Python-backed
operators import it.
"""
