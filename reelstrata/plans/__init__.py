"""Models, consumer queries, audits and the publishing flow."""
