"""Training-data operators: decontamination, toxicity, BPE, top-k search, language model, URL
reputation, sharding, SimHash, quality grades and suffix-array dedup, plus their queries."""
