"""Column expressions: text cleaning, rules, JSON answers, prompts and model calls."""
