"""Operations of a training-data pipeline: filters, fingerprints, joins, tokenizers, packing, archives.

Every operator takes a DataFrame and returns one. Nothing outside this subpackage imports it.
"""
