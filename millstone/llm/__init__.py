"""Training-data operators (chat, dedup, decontamination, scoring, tokens)."""
