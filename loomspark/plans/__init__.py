"""Declared plans: configuration, tasks, recipes, packages, reports and the command line."""
