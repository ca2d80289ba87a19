"""The nightly star build as lazy DataFrames: five dimensions, three facts and
three marts over one operational model. Nothing is executed here; sinks
(``skyfold.sources.sinks``) or callers decide what to write or collect."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from skyfold.operators import dims, facts, marts
from skyfold.sources.fixtures import DEFAULT_AS_OF, FlightModel


class Star:
    def __init__(self, model: FlightModel, as_of: str = DEFAULT_AS_OF,
                 watermark: str | None = None, change_mode: str = "latest", channels: DataFrame | None = None):
        self.m = model
        self._channels = channels
        self.as_of = as_of
        self.watermark = watermark
        self.change_mode = change_mode

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar of the years that the data has; the bounds are part of a snapshot."""
        return dims.dim_date_between(self.m.date_bounds)

    @cached_property
    def dim_route(self) -> DataFrame:
        return dims.dim_route(self.m.route, self.m.airport)

    @cached_property
    def dim_fare(self) -> DataFrame:
        m = self.m
        return dims.dim_fare(m.fare, m.fare_class, m.cabin, m.fare_rule)

    @cached_property
    def dim_flight(self) -> DataFrame:
        m = self.m
        return dims.dim_flight(m.flight_instance, m.scheduled_flight, m.aircraft, m.aircraft_model, self.as_of)

    @cached_property
    def dim_channel(self) -> DataFrame:
        if self._channels is not None:   # a persisted dimension (incremental / streaming loads)
            return self._channels
        return dims.dim_channel(self.m.reservation, self.m.agency)

    @cached_property
    def fact_ticket_sale(self) -> DataFrame:
        m = self.m
        return facts.fact_ticket_sale(m.ticket_dealt, m.itinerary_segment, m.itinerary, m.reservation, m.agency,
                                      m.flight_instance, m.scheduled_flight, m.ancillary, self.dim_channel,
                                      watermark=self.watermark, change_mode=self.change_mode)

    @cached_property
    def fact_flight_occupancy(self) -> DataFrame:
        m = self.m
        return facts.fact_flight_occupancy(m.flight_inventory, m.flight_instance, m.scheduled_flight,
                                           m.ticket, m.itinerary_segment, self.as_of)

    @cached_property
    def fact_reservation_lifecycle(self) -> DataFrame:
        m = self.m
        return facts.fact_reservation_lifecycle(m.reservation, m.reservation_event, m.itinerary,
                                                m.itinerary_segment, m.flight_instance, m.scheduled_flight,
                                                m.agency, m.reservation_passenger, self.dim_channel)

    @cached_property
    def occupancy_by_route(self) -> DataFrame:
        return marts.occupancy_by_route(self.fact_flight_occupancy, self.dim_route, self.dim_date)

    @cached_property
    def revenue_by_fare(self) -> DataFrame:
        return marts.revenue_by_fare(self.fact_ticket_sale, self.dim_fare, self.dim_date)

    @cached_property
    def cancellation_patterns(self) -> DataFrame:
        return marts.cancellation_patterns(self.fact_reservation_lifecycle, self.dim_channel,
                                           self.dim_route, self.dim_date)

    @cached_property
    def lead_time_by_class(self) -> DataFrame:
        return marts.lead_time_by_class(self.fact_ticket_sale, self.dim_fare)

    TABLES = ("dim_date", "dim_route", "dim_fare", "dim_flight", "dim_channel",
              "fact_ticket_sale", "fact_flight_occupancy", "fact_reservation_lifecycle")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.TABLES}
