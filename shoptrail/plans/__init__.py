"""The named jobs: staging, integration, facts, marts, analyses, runs."""
