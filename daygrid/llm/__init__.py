"""Operators of a training-data pipeline: chat, licences, toxicity, URLs, pages, rules, copies, leaks, personal data, packing, token alignment, secrets, spelling."""
