"""DataFrame jobs, one module per stage of the campaign: clean, quality, basket, affinity, recommend, abandonment, campaign, store."""
