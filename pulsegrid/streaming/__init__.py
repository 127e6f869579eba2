"""Incremental work as Structured Streaming: new files once, late samples, repeated exams, running quality."""
