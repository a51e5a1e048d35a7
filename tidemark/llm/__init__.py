"""Training-data operators: mixing, sharding, quality rules, PII, HTML text, quality model,
BPE, URL lists, exact search, near-duplicates, manifests, collocations and fingerprints. Nothing outside this folder imports it."""
