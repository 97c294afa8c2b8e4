"""Whole tables and flows: staging, marts, dashboard, planning, builds."""
