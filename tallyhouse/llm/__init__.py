"""Operations of a training-data pipeline, over tables of documents (doc_id, text, lang, source, n_chars)."""
