"""DataFrame operators: gate, answers, zero-shot, merge, evaluation, monitoring, feedback, features, rank."""
