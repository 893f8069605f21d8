"""Column expressions: text, messages, judge scores, replies, classifications."""
