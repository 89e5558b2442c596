"""Larger plans made of operators: assembly, actions, scores, cohorts, splits, tasks, demographics."""
