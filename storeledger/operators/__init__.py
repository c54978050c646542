"""DataFrame-to-DataFrame steps: validation, metrics, verdicts, alerts, health."""
