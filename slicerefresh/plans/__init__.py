"""Multi-step plans: staged publication and the publishing jobs."""
